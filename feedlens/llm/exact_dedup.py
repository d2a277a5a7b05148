"""Exact deduplication by content-defined chunk recipes.

A text is normalised (white space ``[\\x20\\x09-\\x0D]`` deleted), cut where a rolling
hash of the last 32 bytes ends in zero bits, and described by its recipe: the ordered
list of its chunks' identifiers. Chunks are deduplicated over the corpus by content;
an identifier is a 128-bit hash, verified by holding the distinct contents under each
hash against each other. Where different contents share one, the number of the
content joins the recipe. Equal recipes then mean equal texts, so only recipes (16
bytes a chunk) move when rows are grouped, never the long texts.
"""

from __future__ import annotations

import hashlib
import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from feedlens.llm.common import materialise, read_table, text_udf, with_row_key

MIN_CHUNK, MAX_CHUNK, CUT_BITS = 1024, 16384, 12
ID_BYTES = 16
_GEAR = np.random.RandomState(20240229).randint(0, 2**32, 256, dtype=np.uint64).astype(np.uint32)
_SPACE = b" \t\n\x0b\x0c\r"


def normalised(text: str | None) -> bytes:
    return (text or "").encode().translate(None, _SPACE)


def cut_points(data: bytes) -> list[int]:
    """Ends of the chunks of ``data``: content-defined, between MIN_CHUNK and MAX_CHUNK
    bytes long (the last may be shorter). Empty data has no chunk."""
    n = len(data)
    if n <= MIN_CHUNK:
        return [n] if n else []
    h = _GEAR[np.frombuffer(data, np.uint8)]
    span = 1
    while span < 32:  # h[i] then covers twice as many bytes: a gear hash by doubling
        longer = h.copy()
        longer[span:] += h[:-span] << np.uint32(span)
        h, span = longer, span * 2
    marks = np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 1
    ends, last = [], 0
    while n - last > MIN_CHUNK:
        k = int(np.searchsorted(marks, last + MIN_CHUNK))
        end = min(int(marks[k]) if k < len(marks) else n, last + MAX_CHUNK, n)
        ends.append(end)
        last = end
    if last < n:
        ends.append(n)
    return ends


def split_chunks(data: bytes) -> list[bytes]:
    ends = cut_points(data)
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def _identifier(chunk: bytes, id_bytes: int) -> bytes:
    return xxhash.xxh3_128_digest(chunk)[:id_bytes]


def recipes(id_bytes: int = ID_BYTES):
    """UDF: text -> (SHA-256 of the normalised text, recipe as joined identifiers)."""

    def described(texts: list[str | None]) -> list[dict]:
        data = [normalised(t) for t in texts]
        return [{"text_sha256": hashlib.sha256(d).hexdigest(),
                 "recipe": b"".join(_identifier(c, id_bytes) for c in split_chunks(d))} for d in data]

    return text_udf("text_sha256 string, recipe binary", lambda: described)


def chunk_lists(id_bytes: int = ID_BYTES):
    """UDF: text -> its chunks in order with their identifiers."""

    def listed(texts: list[str | None]) -> list[list[dict]]:
        return [[{"id": _identifier(c, id_bytes), "content": c} for c in split_chunks(normalised(t))] for t in texts]

    return text_udf("array<struct<id:binary,content:binary>>", lambda: listed)


def collided_chunks(docs: DataFrame, text: str, id_bytes: int = ID_BYTES) -> DataFrame:
    """The verification: (id, digests) of the identifiers that distinct chunks share, with
    the sorted digests of their contents. Empty in practice. Chunks are deduplicated by
    content in the map tasks, so each moves once; what follows handles digests only."""
    distinct = (docs.select(F.explode(chunk_lists(id_bytes)(F.col(text))).alias("c"))
                .select("c.id", "c.content").distinct())
    return (distinct.groupBy("id").agg(F.count("*").alias("n"), F.array_sort(F.collect_set(F.sha2("content", 256))).alias("digests"))
            .filter("n > 1").select("id", "digests"))


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                     row_id: str | None = None, id_bytes: int = ID_BYTES) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256 (and row_id).

    Of the rows with equal normalised text the one with the most code points before
    normalising stays, then the smallest doc_id, then (repeated rows) the smallest row_id.
    Null text counts as empty; a null doc_id comes after all others, and is the keep_id
    only of a group without any id. All empty texts are one group. An empty table gives
    no rows. Extra columns are ignored.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__text"),
                       (F.col(row_id) if row_id else F.monotonically_increasing_id()).alias("__row"))
    described = base.select("doc_id", "__row", "__text", F.coalesce(F.length("__text"), F.lit(0)).alias("__n"),
                            recipes(id_bytes)(F.col("__text")).alias("r"))
    columns = ["doc_id", "__row", "__n", "text_sha256", "recipe"]
    collided = materialise(collided_chunks(base, "__text", id_bytes), "collided")
    if collided.isEmpty():
        light = described.select("doc_id", "__row", "__n", "r.*").withColumn("__variants", F.lit(""))
    else:
        listed = described.select("doc_id", "__row", "__n", "r.*", F.posexplode_outer(chunk_lists(id_bytes)(F.col("__text"))).alias("at", "c"))
        variant = (F.array_position("digests", F.sha2("content", 256)) - 1).alias("variant")
        found = (listed.select(*columns, "at", "c.id", "c.content").join(collided, "id", "left").select(*columns, "at", variant)
                 .groupBy(*columns).agg(F.collect_list(F.when(F.col("variant") > 0, F.struct("at", "variant"))).alias("v")))
        light = found.select(*columns, F.array_join(F.transform(
            F.array_sort("v"), lambda x: F.concat_ws(":", x["at"], x["variant"])), ",").alias("__variants"))
    light = materialise(light, "recipes")
    light = light.withColumn("__key", F.concat_ws("|", F.hex("recipe"), "__variants"))

    # written, so that the join below reads both sides as they are dealt out and Spark can
    # split the rows of a large group over tasks
    groups = materialise(light.groupBy("__key")
              .agg(F.count("*").alias("group_size"),
                   F.min(F.struct((-F.col("__n")).alias("n"), F.col("doc_id").isNull().alias("no_id"),
                                  F.col("doc_id").alias("id"), F.col("__row").alias("row"))).alias("first"))
              .filter("group_size > 1"), "groups")
    out = light.join(groups, "__key", "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("first.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("first.row") == F.col("__row"), F.lit(True)).alias("kept"),
        "text_sha256", "__row")
    return out.withColumnRenamed("__row", row_id) if row_id else out.drop("__row")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read_table(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t,
                  length(coalesce(text, '')) AS n FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t ORDER BY n DESC, doc_id NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
"""


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` without the rows whose text repeats one that stays; all columns."""
    keyed = with_row_key(docs)
    dropped = exact_duplicates(keyed, row_id="__doc_row").filter(~F.col("kept")).select("__doc_row")
    return keyed.join(dropped, "__doc_row", "left_anti").select(*docs.columns)
