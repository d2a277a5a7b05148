"""Chat formatting by prefix-target expansion.

Every turn of a conversation becomes one formatted segment, in which control strings of
the text are escaped reversibly. Every assistant turn is exploded into an example row of
its own, which holds the whole prefix: all segments before it as the context, then its
own; only the reply's characters are trainable. The turns after the last reply belong to
no example and stand in one row without one. All that is said of a conversation is read
back from these rows.

Segments:  user  ``<s>[INST] text [/INST]``   assistant  `` text </s>``
           any other role  ``<s>[ROLE name] text [/ROLE]``
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from feedlens.llm.common import read_table

# A control string has its backslashes after the opening bracket; escaping adds one, so an
# escaped text never holds a bare control string and unescaping takes exactly one away.
_CONTROL = r"(/?INST\]|/?s>|/?ROLE[ \]])"
ESCAPE = (rf"([<\[])(\\*){_CONTROL}", r"$1\\$2$3")
UNESCAPE = (rf"([<\[])\\(\\*){_CONTROL}", r"$1$2$3")
_OPENING = re.compile(r"<s>\[(?:INST|ROLE (?P<role>[^\]]*))\] | ")
_UNESCAPE = re.compile(UNESCAPE[0])
_HELD_CHARS = 1 << 22


def _segment_columns(role: str, text: str) -> dict:
    body = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), F.lit(ESCAPE[0]), F.lit(ESCAPE[1]))
    name = F.coalesce(F.col(role), F.lit(""))
    marked = F.replace(F.replace(name, F.lit("%"), F.lit("%25")), F.lit("]"), F.lit("%5D"))
    before = F.when(name == "user", "<s>[INST] ").when(name == "assistant", " ").otherwise(F.concat(F.lit("<s>[ROLE "), marked, F.lit("] ")))
    after = F.when(name == "user", " [/INST]").when(name == "assistant", " </s>").otherwise(" [/ROLE]")
    return {"segment": F.concat(before, body, after),
            "loss_start": F.when(name == "assistant", F.length(before)),
            "loss_end": F.when(name == "assistant", F.length(before) + F.length(body))}


def read_segments(formatted: str, start: int = 0) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, role, text) of the formatted segments from ``start`` to the end. Texts
    hold no bare control string, so a segment ends at the first one that closes it."""
    while start < len(formatted):
        m = _OPENING.match(formatted, start)
        if m is None:
            raise ValueError("not a formatted turn")
        if m["role"] is not None:
            role, closing = m["role"].replace("%5D", "]").replace("%25", "%"), " [/ROLE]"
        else:
            role, closing = ("assistant", " </s>") if m[0] == " " else ("user", " [/INST]")
        close = formatted.find(closing, m.end())
        if close < 0:
            raise ValueError("not a formatted turn")
        yield start, close + len(closing), role, unescape(formatted[m.end():close])
        start = close + len(closing)


def read_segment(segment: str) -> tuple[str, str]:
    """(role, text) of a formatted segment."""
    read = list(islice(read_segments(segment), 2))
    if len(read) != 1:
        raise ValueError("not a formatted turn")
    return read[0][2:]


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


def formatted_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                    text: str = "text") -> DataFrame:
    """One row per turn, in order: conv_id, turn, role, segment, loss_start, loss_end (the
    trainable characters of an assistant's segment, else null).

    Null text and null role count as empty. Rows of one conversation and turn are ordered
    by role, then text, as they were given; null turns come first; null conv_ids are one
    conversation. A conversation lies in one partition, sorted."""
    said = conversations.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                                F.coalesce(F.col(text), F.lit("")).alias("text"))
    ordered = said.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "turn", "role", *[c.alias(k) for k, c in _segment_columns("role", "text").items()])


_EXPANDED = "conv_id long, example long, turns long, text string, loss_start long, loss_end long"
_SPELLED = "conv_id long, example long, turns_before long, segment string, loss_start long, loss_end long"
_READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, " \
        "n_examples long, context_chars long"


def _arrow_schema(columns: str) -> pa.Schema:
    return pa.schema([(name, pa.string() if kind == "string" else pa.int64()) for name, kind in (c.split() for c in columns.split(", "))])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        step = max(1, min(256, batch.num_rows * _HELD_CHARS // max(batch.nbytes, 1)))
        for a in range(0, batch.num_rows, step):
            yield from batch.slice(a, step).to_pylist()


def _written(rows: Iterator[dict], columns: str, text: str | None = None) -> Iterator[pa.RecordBatch]:
    """Batches of 256 rows, or fewer whose ``text`` has _HELD_CHARS together."""
    kind = _arrow_schema(columns)
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row[text]) if text else 0
        if len(held) == 256 or chars >= _HELD_CHARS:
            yield pa.RecordBatch.from_pylist(held, kind)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, kind)


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for conv, turns in groupby(_rows(batches), lambda r: r["conv_id"]):
            prefix, since, example = "", [], 0
            for n, r in enumerate(turns, 1):
                since.append(r["segment"])
                if r["loss_start"] is not None:
                    prefix = "".join([prefix, *since])
                    target = len(prefix) - len(r["segment"])
                    yield {"conv_id": conv, "example": example, "turns": n, "text": prefix,
                           "loss_start": target + r["loss_start"], "loss_end": target + r["loss_end"]}
                    since = []
                    example += 1
            if since:
                yield {"conv_id": conv, "example": None, "turns": len(since), "text": "".join(since), "loss_start": None, "loss_end": None}
    return _written(rows(), _EXPANDED, "text")


def prefix_target_examples(turns: DataFrame) -> DataFrame:
    """One row for each assistant turn of ``formatted_turns`` (in its order): its number in the
    conversation (``example``, from 0) and ``text``, all segments of the conversation up to
    and with the reply's, ``turns`` in number. The characters loss_start to loss_end of the
    text, the reply, are trainable; all before them is the context and masked. The segments
    after a conversation's last reply come in one more row, whose example and loss are null.

    Examples grow with the square of a conversation's length: that is what the expansion
    makes. A task holds one conversation's text and one batch of examples."""
    return turns.mapInArrow(_expand, _EXPANDED)


def _spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for r in _rows(batches):
            for n, (start, end, *_) in enumerate(read_segments(r["text"])):
                target = n == r["turns"] - 1
                yield {"conv_id": r["conv_id"], "example": r["example"], "turns_before": n, "segment": r["text"][start:end],
                       "loss_start": r["loss_start"] - start if target else None, "loss_end": r["loss_end"] - start if target else None}
    return _written(rows(), _SPELLED, "segment")


def example_texts(expanded: DataFrame) -> DataFrame:
    """The examples as the rows of their segments: conv_id, example, turns_before, segment,
    and the trainable span in the last."""
    return expanded.filter("example IS NOT NULL").mapInArrow(_spell, _SPELLED)


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for conv, held in groupby(_rows(batches), lambda r: r["conv_id"]):
            whole, loss = hashlib.sha256(), hashlib.sha256()
            n = n_loss = chars = examples = context = 0
            before = ""
            for r in held:
                if r["example"] is None:
                    new = 0
                    chars += len(r["text"])
                else:
                    if not r["text"].startswith(before):
                        raise ValueError("an example's context is not what was said before it")
                    new, before = len(before), r["text"]
                    chars = len(before)
                for start, _, role, text in read_segments(r["text"], new):
                    whole.update(f"{role}\n{text}\n".encode())
                    n += 1
                if r["example"] is not None:
                    reply = unescape(r["text"][r["loss_start"]:r["loss_end"]])
                    loss.update(reply.encode())
                    n_loss += len(reply)
                    examples += 1
                    context += start
            yield {"conv_id": conv, "n_turns": n, "turns_sha256": whole.hexdigest(), "loss_chars": n_loss, "loss_sha256": loss.hexdigest(),
                   "formatted_chars": chars, "n_examples": examples, "context_chars": context}
    return _written(rows(), _READ)


def conversation_digests(expanded: DataFrame) -> DataFrame:
    """What the output of ``prefix_target_examples`` says when it is read back, one row per
    conversation: from its examples and what follows the last, the digest of the turns and
    the length of all segments; from what is trainable in the examples, the digest of the
    replies (unescaped); the number of examples and the length of their contexts together.

    Every example must begin with the whole text of the one before it; each turn is read
    where it first appears."""
    return expanded.mapInArrow(_read_back, _READ)


def with_control_conversation(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(extra)


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = with_control_conversation(spark, read_table(spark, sf_dir, "conversations"))
    return conversation_digests(prefix_target_examples(formatted_turns(conversations)))


OP2_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '[<\[]\\*(?:/?INST\]|/?s>|/?ROLE[ \]])')) AS body FROM c),
f AS (
  SELECT *, body + CASE role WHEN 'user' THEN 18 WHEN 'assistant' THEN 6
    ELSE 19 + length(replace(replace(role, '%', '%25'), ']', '%5D')) END AS size FROM e),
g AS (
  SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before FROM f)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(size) AS BIGINT) AS formatted_chars,
       count(*) FILTER (role = 'assistant') AS n_examples,
       CAST(coalesce(sum(before) FILTER (role = 'assistant'), 0) AS BIGINT) AS context_chars
FROM g GROUP BY conv_id
"""
