"""Fill-in-the-middle examples, cut by an indexable skip list.

A text is a row of units (code points, or the matches of a pattern). An indexable skip
list stands over them: a node of the lowest lane holds up to ``NODE`` units, a link of each
express lane jumps ``FAN`` links of the lane below, and every link carries two widths, the
units and the code points that it jumps. A descent adds widths up lane by lane until it
stands at a rank, so the cut before any unit is found with its place in code points in a
logarithmic number of steps. The widths take a link for 64 units, not a number for each.

Which ranks are cut comes from a SHA-256 of the document's id, so a rerun cuts alike.
Documents are put together and taken apart again by Spark's own string functions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from feedlens.llm.common import chunks, read_table

NODE, FAN = 64, 16
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_PERCENT, SPM_PERCENT = 10, 20


class SkipList:
    """Units of a text by rank. ``unit`` is a pattern whose matches, from left to right, are
    the units; what stands between two matches belongs to the later unit, what follows the
    last match to that one, and a text without a match is one unit. None: every code point."""

    def __init__(self, text: str, unit: str | None = None):
        self.text, self.unit = text, regex.compile(unit, regex.S) if unit else None
        units, chars = self._lowest()
        self.lanes = [(units, chars)]
        while len(self.lanes[-1][0]) > FAN:
            units, chars = self.lanes[-1]
            at = np.arange(0, len(units), FAN)
            self.lanes.append((np.add.reduceat(units, at), np.add.reduceat(chars, at)))
        self.n = int(self.lanes[-1][0].sum())

    def _lowest(self) -> tuple[np.ndarray, np.ndarray]:
        """Widths of the lowest lane's links in units and in code points."""
        if self.unit is None:
            size = len(self.text)
            widths = np.full(-(-size // NODE), NODE, np.int64)
            if size % NODE:
                widths[-1] = size % NODE
            return widths, widths
        ends, n, last = [0], 0, 0
        for last in self._ends(0):
            n += 1
            if n % NODE == 0:
                ends.append(last)
        units = [NODE] * (len(ends) - 1)
        if n % NODE:
            units.append(n % NODE)
            ends.append(last)
        elif not n and self.text:
            units, ends = [1], [0, 0]
        ends[-1] = len(self.text)
        return np.array(units, np.int64), np.diff(np.array(ends, np.int64))

    def _ends(self, start: int) -> Iterator[int]:
        return (m.end() for m in self.unit.finditer(self.text, start) if m.end() > m.start())

    def place(self, rank: int) -> int:
        """Code points before the unit of this rank (0 to ``n``; ``n``: the text's length)."""
        if rank >= self.n:
            return len(self.text)
        link = units = chars = 0
        for lane in reversed(self.lanes):
            link *= FAN
            while units + lane[0][link] <= rank:
                units += int(lane[0][link])
                chars += int(lane[1][link])
                link += 1
        if self.unit is None:
            return chars + rank - units
        ends = self._ends(chars)
        for _ in range(rank - units):
            chars = next(ends)
        return chars


def cuts_udf(unit: str | None):
    """UDF: text and two unsigned numbers -> units ``n`` and the code points before the
    smaller and the larger of the numbers modulo n + 1."""
    kind = DataType.fromDDL("struct<n:long,first:long,second:long>")
    arrow_kind = to_arrow_type(kind)

    @arrow_udf(kind)
    def cut(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, one, two in batches:
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
            rows = []
            for a, b in chunks(sizes):
                for text, x, y in zip(*(c.slice(a, b - a).to_pylist() for c in (texts, one, two))):
                    units = SkipList(text or "", unit)
                    low, high = sorted((x % (units.n + 1), y % (units.n + 1)))
                    rows.append({"n": units.n, "first": units.place(low), "second": units.place(high)})
            yield pa.array(rows, arrow_kind)

    return cut


def _number(digest: Column, k: int) -> Column:
    """The k-th 8-digit group (from 1) of a hexadecimal digest as an unsigned number."""
    return F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("long")


def fim_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", unit: str | None = None, salt: str = "1:",
                  plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n (units), form, prefix_chars, middle_chars
    (code points; null if plain), output.

    Null text counts as empty; an empty text, and one that holds a sentinel, is plain:
    the output is the text. A null id hashes as the salt alone; repeated rows and ids are
    cut alike, each in its own row; an empty table gives no rows. Other columns are dropped."""
    id_text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(salt), id_text).cast("binary"), 256)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("__text"), digest.alias("__h"))
    t, h = F.col("__text"), F.col("__h")
    held = F.contains(t, F.lit(PREFIX)) | F.contains(t, F.lit(SUFFIX)) | F.contains(t, F.lit(MIDDLE))
    plain = (t == "") | held | (_number(h, 3) % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(_number(h, 4) % 100 < spm_percent, "spm").otherwise("psm")
    rows = rows.select("doc_id", "__text", form.alias("form"), cuts_udf(unit)(t, _number(h, 1), _number(h, 2)).alias("__cut"))
    first, second = F.col("__cut.first"), F.col("__cut.second")

    def part(start: Column, size: Column) -> Column:
        return F.substr(t, start.cast("int") + 1, size.cast("int"))

    prefix, middle, suffix = part(F.lit(0), first), part(first, second - first), part(second, F.char_length(t))
    output = (F.when(F.col("form") == "plain", t)
              .when(F.col("form") == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
              .otherwise(F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)))
    cut = F.col("form") != "plain"
    return rows.select("doc_id", F.col("__cut.n").alias("n"), "form", F.when(cut, first).alias("prefix_chars"),
                       F.when(cut, second - first).alias("middle_chars"), output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text that ``fim_documents`` was given, from its output and form alone. Cut texts
    hold no sentinel, so the first of each kind is the one that was put there."""
    def between(opening: str, closing: str) -> Column:
        return F.substring_index(F.substr(output, F.lit(len(opening) + 1)), closing, 1)

    def after(mark: str) -> Column:
        return F.substr(output, F.locate(mark, output) + len(mark))

    second = {"psm": SUFFIX, "spm": PREFIX}
    head = {f: between(PREFIX if f == "psm" else SUFFIX, s) for f, s in second.items()}
    tail = {f: F.substring_index(after(s), MIDDLE, 1) for f, s in second.items()}
    return (F.when(form == "psm", F.concat(head["psm"], after(MIDDLE), tail["psm"]))
            .when(form == "spm", F.concat(tail["spm"], after(MIDDLE), head["spm"]))
            .otherwise(output))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim_documents(read_table(spark, sf_dir, "documents"))
    back = restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(back.cast("binary"), 256).alias("restored_sha256"))


OP12_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
k AS (
  SELECT doc_id, t, length(t) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM k),
p AS (
  SELECT *, substr(t, 1, CAST(a AS INT)) AS prefix, substr(t, CAST(a AS INT) + 1, CAST(b - a AS INT)) AS middle,
         substr(t, CAST(b AS INT) + 1) AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
