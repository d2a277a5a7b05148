"""Packing documents into sequences by length patterns and non-negative least squares.

Only the histogram of lengths (at most ``capacity`` numbers) reaches the driver. Patterns
of two or three lengths that fill a sequence exactly are enumerated, their repeat counts
fitted to the histogram by non-negative least squares, scaled, rounded down to what is
there, and the residual lengths packed best-fit, longest first, on counts. The result is
a plan of as many entries as patterns; every piece finds its place by its length and its
rank among the pieces of that length.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from itertools import accumulate, chain, islice

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.functions import pandas_udf
from tokenizers import Tokenizer

from feedlens.llm.common import materialise, read_table, text_udf, worker_state

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
COMMON_LENGTHS = 96      # lengths from which triples are built
FIT_ROUNDS = 400
SCALES = (1.0, 0.98, 0.9, 0.7, 0.4, 0.0)   # shares of the fitted counts that are tried
WORD_CACHE = 700_000


class WordEncoder:
    """Ids of texts by a tokenizer whose pre-tokenizer splits words, numbers and signs.

    Words repeat, so ids are kept by word. That holds for texts of the characters below
    U+0250 that need no composition and hold no special token; any other text goes to
    the tokenizer as it is, so the ids are the tokenizer's own for every text."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks share the cores
        self.tokenizer = Tokenizer.from_file(path)
        chars = [chr(c) for c in range(0x250)]
        letters = "".join(c for c in chars if unicodedata.category(c)[0] == "L")
        numbers = "".join(c for c in chars if unicodedata.category(c)[0] == "N")
        spaces = " \t\n\x0b\x0c\r\xa0"
        own = "".join(map(re.escape, letters)), "".join(map(re.escape, numbers)), re.escape(spaces)
        self.split = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[{0}]+|[{1}]|[^{2}{0}{1}]+".format(*own)).findall
        self.other = re.compile("[^\x00-\x1b\x20-\x84\x86-įı-ɏ]").search
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[k for word, k in vocabulary.items() if word.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.uint32).tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        plain = [not self.other(t) and "<|" not in t for t in texts]
        split = [self.split(t.lower()) if p else [] for t, p in zip(texts, plain)]
        if len(self.known) > WORD_CACHE:
            self.known = dict(islice(self.known.items(), WORD_CACHE // 3))  # the common words come first
        words = list(chain.from_iterable(split))
        ids = list(map(self.known.get, words))
        fresh = [k for k, found in enumerate(ids) if found is None]
        self._learn(list(dict.fromkeys(words[k] for k in fresh)))
        for k in fresh:
            ids[k] = self.known[words[k]]
        ends = list(accumulate(map(len, split), initial=0))
        return [b"".join(ids[a:b]) if p else self._ids([t])[0] for t, p, a, b in zip(texts, plain, ends, ends[1:])]

    def _learn(self, words: list[str]) -> None:
        """Encode words as one text; each ends with the first id that ends a word."""
        if not words:
            return
        ids = np.frombuffer(self._ids([" ".join(words)])[0], np.uint32)
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words):
            raise ValueError("the tokenizer does not mark the ends of words")
        data = ids.tobytes()
        self.known.update((w, data[4 * a:4 * b]) for w, a, b in zip(words, [0, *ends.tolist()], ends.tolist()))


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a tokenizer file, kept from task to task."""
    kept = worker_state()
    if path not in kept:
        kept[path] = WordEncoder(path)
    return kept[path]


def pieces_udf(tokenizer: str, capacity: int, end_id: int, with_ids: bool = True):
    """UDF: text -> its pieces (piece, start, length, ids_crc32, and the ids if asked for)."""
    end, width = np.array([end_id], np.uint32).tobytes(), 4 * capacity

    def make():
        encode = encoder(public_tokenizers.path(tokenizer)).encode

        def cut(texts: list[str | None]) -> list[list[dict]]:
            rows = []
            for ids in encode([t or "" for t in texts]):
                ids += end
                parts = [ids[a:a + width] for a in range(0, len(ids), width)]
                rows.append([{"piece": k, "start": k * capacity, "length": len(part) // 4, "ids_crc32": zlib.crc32(part)}
                             | ({"ids": part} if with_ids else {}) for k, part in enumerate(parts)])
            return rows

        return cut

    return text_udf(f"array<struct<piece:int,start:long,length:long,ids_crc32:long{',ids:binary' if with_ids else ''}>>", make)


def token_pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER,
                 capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, ids (little-endian unsigned 32-bit; left in the
    Python worker unless asked for) of the whole texts, ``end_id`` after each; a text over
    ``capacity`` ids is cut into pieces. Null and empty texts are the end id alone."""
    cut = pieces_udf(tokenizer, capacity, end_id, with_ids)
    return (docs.select(F.col(doc_id).alias("doc_id"), F.explode(cut(F.col(text))).alias("p"))
            .select("doc_id", "p.*"))


def patterns(counts: np.ndarray, common: int = COMMON_LENGTHS) -> np.ndarray:
    """Rows of three lengths, 0 for none, that fill the capacity exactly: all pairs, and
    the triples of which two are among the ``common`` commonest lengths. counts[n]: how
    many pieces have length n, up to the capacity."""
    capacity = len(counts) - 1
    here = np.flatnonzero(counts)
    pairs = [(capacity - n, n, 0) for n in here.tolist() if n <= capacity - n < capacity and counts[capacity - n]]
    top = sorted(here, key=lambda n: (-counts[n], n))[:common]
    triples = {tuple(sorted((int(a), int(b), int(capacity - a - b)), reverse=True))
               for a in top for b in top if a + b < capacity and counts[capacity - a - b]}
    return np.array(sorted(pairs) + sorted(triples), np.int64).reshape(-1, 3)


def fit_repeats(found: np.ndarray, counts: np.ndarray, rounds: int = FIT_ROUNDS) -> np.ndarray:
    """x >= 0 that minimises |A x - counts|, A[n, p]: how often length n stands in pattern
    p; by accelerated projected gradient steps."""
    size = len(counts)
    target = counts.astype(float)
    target[0] = 0
    scale = max(1.0, target.max())
    target /= scale
    used = found > 0

    def forward(x):
        return np.bincount(found.ravel(), np.repeat(x, 3) * used.ravel(), size)

    def back(r):
        return (r[found] * used).sum(axis=1)

    v = np.ones(len(found))
    for _ in range(30):  # the largest eigenvalue of A'A by the power method
        w = back(forward(v))
        bound = np.linalg.norm(w) / max(np.linalg.norm(v), 1e-300)
        v = w / max(np.linalg.norm(w), 1e-300)
    step = 1.0 / (1.05 * max(bound, 1e-9))
    x = y = np.zeros(len(found))
    t = 1.0
    for _ in range(rounds):
        nxt = np.maximum(0.0, y - step * back(forward(y) - target))
        t_next = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = nxt + (t - 1) / t_next * (nxt - x)
        x, t = nxt, t_next
    return x * scale


def rounded(found: np.ndarray, repeats: np.ndarray, counts: np.ndarray) -> tuple[list, np.ndarray]:
    """(lengths, repeats) with whole repeats that the counts allow, and what is left."""
    left = counts.copy()
    out = []
    for p in np.argsort(-repeats, kind="stable"):
        lengths, times = np.unique(found[p][found[p] > 0], return_counts=True)
        n = int(min(round(float(repeats[p])), (left[lengths] // times).min()))
        if n > 0:
            left[lengths] -= n * times
            out.append((tuple((int(a), int(b)) for a, b in zip(lengths[::-1], times[::-1])), n))
    return out, left


def best_fit(counts: np.ndarray) -> list:
    """Best-fit decreasing on counts: (runs of (length, times), sequences) of like sequences."""
    capacity = len(counts) - 1
    free: list[list] = [[] for _ in range(capacity + 1)]   # by space left: [runs, sequences]
    for length in range(capacity, 0, -1):
        n, space = int(counts[length]), length
        while n:
            while space <= capacity and not free[space]:
                space += 1
            if space > capacity:
                runs, have = (), n
                space_now = capacity
            else:
                runs, have = free[space].pop()
                space_now = space
            each = space_now // length
            full = min(have, n // each)
            if full:
                free[space_now - each * length].append([(*runs, (length, each)), full])
                n -= full * each
                have -= full
            if have and n and n < each:
                free[space_now - n * length].append([(*runs, (length, n)), 1])
                n, have = 0, have - 1
            if have and runs:
                free[space_now].append([runs, have])
    return [(tuple(runs), n) for groups in free for runs, n in groups]


def pack_plan(counts: np.ndarray) -> list:
    """(runs of (length, times), sequences) that hold every piece of the histogram once,
    in as few sequences as the scales tried give."""
    found = patterns(counts)
    repeats = fit_repeats(found, counts) if len(found) else np.zeros(0)
    best = None
    for share in SCALES:
        fitted, left = rounded(found, share * repeats, counts)
        plan = fitted + best_fit(left)
        if best is None or sum(n for _, n in plan) < sum(n for _, n in best):
            best = plan
    return best


def plan_entries(plan: list) -> np.ndarray:
    """Rows (length, first rank, first sequence, times, offset), by length and rank."""
    rows, used, sequence = [], {}, 0
    for runs, n in plan:
        offset = 0
        for length, times in runs:
            rows.append((length, used.get(length, 0), sequence, times, offset))
            used[length] = used.get(length, 0) + n * times
            offset += length * times
        sequence += n
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _placed(entries: np.ndarray):
    @pandas_udf("sequence_id long, offset long")
    def place(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        n, r = lengths.to_numpy(np.int64), ranks.to_numpy(np.int64)
        at = np.searchsorted(entries[:, 0] * (1 << 44) + entries[:, 1], n * (1 << 44) + r, side="right") - 1
        e = entries[at]
        inside = r - e[:, 1]
        return pd.DataFrame({"sequence_id": e[:, 2] + inside // e[:, 3], "offset": e[:, 4] + inside % e[:, 3] * n})

    return place


def assign_sequences(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with a ``length`` of 1 to ``capacity``) and sequence_id, offset.

    The pieces are written to the shared folder first. A piece's rank among those of its
    length is its place in its file plus the number of such pieces in the files before,
    so no length, however common, meets in one task."""
    pieces = materialise(pieces, "pieces")
    histogram = pieces.groupBy("length").count().collect()   # at most ``capacity`` rows
    counts = np.zeros(capacity + 1, np.int64)
    for row in histogram:
        counts[row["length"]] = row["count"]
    keyed = pieces.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__at"))
    before = (keyed.groupBy("__file", "length").agg(F.count("*").alias("__n"))
              .select("__file", "length", (F.sum("__n").over(W.partitionBy("length").orderBy("__file")) - F.col("__n")).alias("__before")))
    ranked = keyed.withColumn("__rank", F.row_number().over(W.partitionBy("__file", "length").orderBy("__at")) - 1)
    place = _placed(plan_entries(pack_plan(counts)))
    return (ranked.join(before, ["__file", "length"])
            .withColumn("__place", place("length", F.col("__rank") + F.col("__before")))
            .select(*pieces.columns, "__place.sequence_id", "__place.offset"))


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER,
                   capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and
    the ids themselves if asked for. Null text counts as empty (one end id); repeated rows
    and null doc_ids are packed like any other; an empty table gives no rows."""
    pieces = token_pieces(docs, doc_id, text, tokenizer, capacity, end_id, with_ids)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return assign_sequences(pieces, capacity).select(*columns, *(["ids"] if with_ids else []))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The last stage: where each piece of ``docs`` stands in the training sequences."""
    return pack_documents(docs)
