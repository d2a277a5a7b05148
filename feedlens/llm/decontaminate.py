"""Benchmark decontamination under edit distance.

Benchmark items and documents are compared as word sequences (lower case, ``\\w+``). An
item leaks where its word edit distance to a stretch of a document is at most a fifth
of its words. Three steps, all over every position of every text:

1. A lossless screen. Of an item's first k + 1 words one stands in its leak untouched, where
   k edits are allowed; from the first such word on, k edits leave at least n - k of its n
   words and n - 1 - 2k of its word pairs standing within n + k words. Starts on none of an
   item's first 2k + 1 words, or with fewer pairs (or less than n - 2k words) of the benchmark
   after them, are passed over. Items are grouped by length for this.
2. CGK embedding and bit sampling. A random walk repeats or advances, the choice hashed from
   step and word; two windows a few edits apart meet again after each edit and agree in most
   steps, so edit distance becomes Hamming distance. Item-sized windows are embedded from
   each remaining start, and items from each of their first 2k + 1 words, so that edits at an
   item's front shift neither walk: a block of edits ends before one of these words or begins
   after k + 1 whole ones. Windows that agree with an item in the sampled steps of
   one of R walks are candidates. R is doubled until every pattern of edits at the limit
   (scattered, leading, trailing, in one block; words replaced, dropped or put in) is recalled
   at ``TARGET_RECALL``.
3. The exact edit distance of each candidate, by dynamic programming.

Items come in blocks of proven size, which are sent to the tasks, one block at a time; every
block meets all rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from feedlens.llm.common import materialise, mix64, read_table, text_udf

SHARE = 0.2                # edits allowed, as a share of an item's words
SAMPLED = 3                # steps of a walk that make a key
TARGET_RECALL = 0.995      # of each pattern of edits, in ``TRIALS`` edited items a length class
TRIALS = 400
FEWEST_ROUNDS, MOST_ROUNDS = 16, 1024
WINDOWS = 1 << 12          # windows that are embedded at once
BLOCK_ITEMS, BLOCK_CHARS = 20_000, 16_000_000
_WORDS = re.compile(r"\w+")
_UNKNOWN = np.uint64(0x9E3779B97F4A7C15)
HIT = "item_id:long,start_char:long,end_char:long,distance:int,item_words:int"
PATTERNS = ("scattered", "leading", "trailing", "block")


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").lower())


def allowed(n: int) -> int:
    return int(SHARE * n)


def starts_of(n: int) -> int:
    """How many of an item's first words are starts."""
    return min(2 * allowed(n) + 1, n)


def edited(x: np.ndarray, pattern: str, rng: np.random.RandomState) -> np.ndarray:
    """``x`` with as many edits as allowed, by a pattern; an unknown word 0 replaces words or
    is put in."""
    words, k = x.tolist(), allowed(len(x))
    kinds = rng.randint(3, size=k) if pattern == "scattered" else np.full(k, rng.randint(3))
    if pattern == "scattered":
        for kind in kinds:
            at = rng.randint(len(words))
            words[at:at + (kind != 1)] = [] if kind == 2 else [0]
    else:
        last = len(words) - k
        at = {"leading": 0, "trailing": last, "block": rng.randint(last + 1)}[pattern]
        kind = kinds[0] if k else 2
        words[at:at + (k if kind != 1 else 0)] = [] if kind == 2 else [0] * k
    return np.array(words, np.int64)


class LengthClass:
    """Items of about one length with their keys."""

    def __init__(self, members: list[int], items: list[np.ndarray], rng: np.random.RandomState, target: float):
        sizes = [len(items[i]) for i in members]
        self.low, self.high = min(sizes), max(sizes)
        self.span = self.high + allowed(self.high)
        self.pairs_least = min(n - 1 - 2 * allowed(n) for n in sizes)
        self.words_least = min(n - 2 * allowed(n) for n in sizes)
        self.first = np.zeros(1 + max(int(x.max()) for x in items), bool)
        for i in members:
            self.first[items[i][:starts_of(len(items[i]))]] = True
        self.steps = self.low                      # the walk of a whole copy stays inside the item
        self.sampled = min(SAMPLED, self.steps)
        self.recall: dict[str, float] = {}
        chosen = [items[members[k]] for k in rng.randint(0, len(members), TRIALS)]
        tried = {p: [edited(x, p, rng) for x in chosen] for p in PATTERNS}
        rounds = FEWEST_ROUNDS
        while True:
            self.walk = rng.randint(1, 2**62, (rounds, self.steps)).astype(np.uint64) * np.uint64(2) + np.uint64(1)
            self.places = np.sort(np.array([rng.choice(self.steps, self.sampled, False) for _ in range(rounds)]), axis=1)
            self.factor = rng.randint(1, 2**62, (rounds, self.sampled)).astype(np.uint64) * np.uint64(2) + np.uint64(1)
            self.recall = {p: self._recalled(chosen, ys) for p, ys in tried.items()}
            if rounds >= MOST_ROUNDS or min(self.recall.values()) >= target:
                break
            rounds *= 2
        self.rounds = rounds
        windows, self.item, self.shift = self._shifted([items[i] for i in members], members)
        keys = self.keys(windows)
        order = np.argsort(keys, axis=1, kind="stable")
        self.rows = []     # a round: its distinct keys, and the first row and number of rows of each in ``order``
        for r in range(rounds):
            own, first, n = np.unique(keys[r][order[r]], return_index=True, return_counts=True)
            self.rows.append((own, first, n, order[r]))

    def _shifted(self, items: list[np.ndarray], numbers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The window of each item from each of its first words, with the item and the shift."""
        rows = [(x[j:], i, j) for x, i in zip(items, numbers) for j in range(starts_of(len(x)))]
        return self._padded([x for x, _, _ in rows]), np.array([i for _, i, _ in rows], np.int64), np.array([j for _, _, j in rows], np.int64)

    def _padded(self, items: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(items), self.span), np.int64)
        for k, x in enumerate(items):
            out[k, :len(x)] = x[:self.span]
        return out

    def _recalled(self, items: list[np.ndarray], texts: list[np.ndarray]) -> float:
        """Share of the items that a key of their edited text finds, from any start on one of
        the item's first words."""
        windows, item, shift = self._shifted(items, range(len(items)))
        own = self.keys(windows)
        starts = [(i, p, j) for i, (x, y) in enumerate(zip(items, texts)) for j in range(starts_of(len(x)))
                  for p in np.flatnonzero(y == x[j]).tolist() if p <= j + allowed(len(x))]
        row = {(i, j): r for r, (i, j) in enumerate(zip(item.tolist(), shift.tolist()))}
        found = np.zeros(len(items), bool)
        for a in range(0, len(starts), WINDOWS):
            some = starts[a:a + WINDOWS]
            keys = self.keys(self._padded([texts[i][p:] for i, p, _ in some]))
            hit = (keys == own[:, [row[i, j] for i, _, j in some]]).any(axis=0)
            found[[i for (i, _, _), h in zip(some, hit) if h]] = True
        return float(found.mean())

    def keys(self, windows: np.ndarray) -> np.ndarray:
        """(rounds, windows) keys: the sampled steps of each walk, hashed together."""
        symbol = np.where(windows == 0, _UNKNOWN, mix64(windows))
        rows, last = np.arange(len(windows)), windows.shape[1] - 1
        out = np.zeros((len(self.walk), len(windows)), np.uint64)
        at = np.zeros(out.shape, np.int64)
        for j in range(int(self.places.max()) + 1):
            here = symbol[rows, np.minimum(at, last)]
            for r, t in zip(*np.nonzero(self.places == j)):
                out[r] ^= mix64(here[r] * self.factor[r, t])
            at += ((here * self.walk[:, j, None]) >> np.uint64(63)).astype(np.int64)
        return out

    def candidates(self, windows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window, row of ``item`` and ``shift``) pairs that agree in a round."""
        for keys, (own, first, n, order) in zip(self.keys(windows), self.rows):
            spot = np.minimum(np.searchsorted(own, keys), len(own) - 1)
            hit = np.flatnonzero(own[spot] == keys)
            many = n[spot[hit]]
            row = np.repeat(first[spot[hit]] - np.cumsum(many) + many, many) + np.arange(many.sum())
            yield np.repeat(hit, many), order[row]


class ItemIndex:
    """A block of benchmark items, ready to be searched for in texts."""

    def __init__(self, items: list[tuple[int, str]], target: float = TARGET_RECALL):
        split = [(i, words_of(t)) for i, t in items]
        split = [(i, w) for i, w in split if w]
        self.ids = [i for i, _ in split]
        self.known = {w: k + 1 for k, w in enumerate(dict.fromkeys(w for _, ws in split for w in ws))}
        self.items = [np.array([self.known[w] for w in ws], np.int64) for _, ws in split]
        size = 1 << max(16, math.ceil(math.log2(16 * sum(map(len, self.items)) + 1)))
        self.pair_bits = np.zeros(size, bool)
        for x in self.items:
            self.pair_bits[self._pair(x[:-1], x[1:])] = True
        rng = np.random.RandomState(11)
        self.classes: list[LengthClass] = []
        order = sorted(range(len(self.items)), key=lambda k: len(self.items[k]))
        while order:
            top = max(len(self.items[order[0]]) * 1.2, len(self.items[order[0]]) + 1)
            members = [k for k in order if len(self.items[k]) <= top]
            order = order[len(members):]
            self.classes.append(LengthClass(members, self.items, rng, target))

    def _pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        mixed = (a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (b.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        return (mixed >> np.uint64(20)).astype(np.int64) & (len(self.pair_bits) - 1)

    def search(self, texts: list[str | None]) -> list[list[dict]]:
        """The leaks of each text, a list of one entry for every item and place."""
        texts = [t or "" for t in texts]
        out: list[list[dict]] = [[] for _ in texts]
        get = self.known.get
        coded = [np.fromiter(map(get, words_of(t), repeat(0)), np.int64) for t in texts]
        ends = np.cumsum([len(c) for c in coded])
        ids = np.concatenate(coded) if coded else np.zeros(0, np.int64)
        if not len(ids) or not self.items:
            return out
        inside = ids > 0
        pair = np.zeros(len(ids), bool)
        both = np.flatnonzero(inside[:-1] & inside[1:])
        pair[both] = self.pair_bits[self._pair(ids[both], ids[both + 1])]
        words_to = np.concatenate(([0], np.cumsum(inside, dtype=np.int32)))
        pairs_to = np.concatenate(([0], np.cumsum(pair, dtype=np.int32)))
        n = len(ids)
        found = [np.zeros((0, 3), np.int64)]
        begins = ends - [len(c) for c in coded]
        widest = max(c.span for c in self.classes)
        near = pairs_to[np.minimum(np.arange(n) + widest, n)] - pairs_to[:n]
        some_class = np.flatnonzero((near >= min(c.pairs_least for c in self.classes)) & inside)
        for c in self.classes:
            starts = some_class[c.first[ids[some_class]]]
            stop = np.minimum(starts + c.span, n)
            starts = starts[(pairs_to[np.maximum(stop - 1, 0)] - pairs_to[starts] >= c.pairs_least)
                            & (words_to[stop] - words_to[starts] >= c.words_least)]
            for first in range(0, len(starts), WINDOWS):
                some = starts[first:first + WINDOWS]
                doc = np.searchsorted(ends, some, side="right")
                at = some[:, None] + np.arange(c.span)
                windows = np.where(at < ends[doc][:, None], ids[np.minimum(at, n - 1)], 0)
                for window, row in c.candidates(windows):
                    found.append(np.stack([doc[window], c.item[row], some[window] - c.shift[row]], axis=1))
        rows = np.unique(np.concatenate(found), axis=0)
        groups = np.flatnonzero(np.concatenate(([True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)))) if len(rows) else []
        for a, b in zip(groups, [*groups[1:], len(rows)]):
            doc, item = rows[a, :2].tolist()
            x, begin, spans = self.items[item], int(begins[doc]), None
            k = allowed(len(x))
            for lo, hi in _regions(rows[a:b, 2].tolist(), len(x), k):
                lo, hi = max(lo, begin), min(hi, int(ends[doc]))
                if not _holds(x, ids[lo:hi], k):
                    continue
                for distance, first, last in near_stretches(x, ids[lo:hi], k):
                    spans = spans or [m.span() for m in _WORDS.finditer(texts[doc].lower())]
                    out[doc].append({"item_id": self.ids[item], "start_char": spans[lo - begin + first][0],
                                     "end_char": spans[lo - begin + last - 1][1], "distance": distance,
                                     "item_words": len(x)})
        return out


def _holds(x: np.ndarray, text: np.ndarray, k: int) -> bool:
    """Whether len(x) - k words of ``x`` stand somewhere within len(x) + k words of ``text``."""
    so_far = np.concatenate(([0], np.cumsum(np.isin(text, x))))
    stop = np.minimum(np.arange(len(so_far)) + len(x) + k, len(text))
    return int((so_far[stop] - so_far).max()) >= len(x) - k


def _regions(starts: list[int], n: int, k: int) -> Iterator[tuple[int, int]]:
    """Stretches around starts that stand within n words of each other."""
    begin = last = starts[0]
    for s in starts[1:]:
        if s - last > n:
            yield begin - k, last + n + 2 * k + 1
            begin = s
        last = s
    yield begin - k, last + n + 2 * k + 1


def _last_row(x: np.ndarray, text: np.ndarray, free_start: bool) -> np.ndarray:
    """Edit distance of all of ``x`` to the stretches of ``text`` that end at 0, 1, ..."""
    steps = np.arange(len(x) + 1)
    column = steps.copy()
    out = [column[-1]]
    for j, word in enumerate(text.tolist()):
        best = np.empty_like(column)
        best[0] = 0 if free_start else j + 1
        best[1:] = np.minimum(column[:-1] + (x != word), column[1:] + 1)
        column = np.minimum.accumulate(best - steps) + steps
        out.append(column[-1])
    return np.array(out)


def nearest_stretch(x: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(distance, begin, end) of the stretch of ``text`` nearest to ``x``; the first of
    the nearest, and of those the shortest. The item ``x`` has no unknown word 0."""
    to = _last_row(x, text, True)
    end = int(to.argmin())
    back = _last_row(x[::-1], text[:end][::-1], False)
    length = int(np.flatnonzero(back == to[end])[0])
    return int(to[end]), end - length, end


def near_stretches(x: np.ndarray, text: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(distance, begin, end) of disjoint stretches of ``text`` within ``k`` of ``x``, in
    order; none is within ``k`` in what they leave. Of stretches that overlap the nearest
    is taken first. A few item lengths of text are looked at at once."""
    reach, at = len(x) + k, 0
    out: list[tuple[int, int, int]] = []
    while at < len(text):
        near = np.flatnonzero(_last_row(x, text[at:at + 3 * reach], True) <= k)
        if not len(near):
            if at + 3 * reach >= len(text):
                break
            at += 2 * reach   # a stretch has ``reach`` words at most
        elif near[0] > 2 * reach:   # what may overlap isn't all in view
            at += int(near[0]) - reach
        else:
            distance, first, last = nearest_stretch(x, text[at:at + int(near[0]) + reach])
            before = max(0, int(near[0]) - reach)   # no stretch ends before near[0]
            out += [(d, at + before + a, at + before + b) for d, a, b in near_stretches(x, text[at + before:at + first], k)]
            out.append((distance, at + first, at + last))
            at += last
    return out


def item_blocks(items: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[list[tuple[int, str]]]:
    """The items on the driver, a block of bounded size at a time; null texts left out."""
    rows = items.select(F.col(item_id).alias("i"), F.col(text).alias("t")).filter("t IS NOT NULL")
    n, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.length("t")), F.lit(0))).first()
    blocks = max(1, math.ceil(n / BLOCK_ITEMS), math.ceil(size / BLOCK_CHARS))
    for b in range(blocks):
        yield [(r.i, r.t) for r in rows.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b)
               .orderBy("i", "t").collect()]


def _search_udf(index: ItemIndex):
    return text_udf(f"array<struct<{HIT}>>", lambda: index.search)


def benchmark_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row for every leak: doc_id, item_id, start_char, end_char, distance, item_words.

    Character places are those of the lower-cased text. Null and empty texts, and items
    without a word, leak nothing. Repeated documents and repeated items give a row each;
    so does every repeat of an item in one document, back to back or apart (of stretches
    that overlap the nearest). Empty tables give no rows. Of a benchmark of several blocks
    each block's leaks are written before the next block is built."""
    def leaks(block):
        hits = F.explode(_search_udf(ItemIndex(block))(F.col(text)))
        return docs.select(F.col(doc_id).alias("doc_id"), hits.alias("hit")).select("doc_id", "hit.*")

    found, waiting = None, None
    for block in item_blocks(items, item_id, item_text):
        if waiting is not None:      # there are several
            part = materialise(waiting, "leaks")
            found = part if found is None else found.unionByName(part)
        waiting = leaks(block)
    return waiting if found is None else found.unionByName(waiting)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; all columns. The documents
    that one block of the benchmark leaves are written before the next block is built, so a
    task holds one block's index."""
    kept, first = docs, True
    for block in item_blocks(read_table(spark, sf_dir, "benchmark")):
        kept = kept if first else materialise(kept, "decontaminated")
        leaks = F.size(_search_udf(ItemIndex(block))(F.col("text")))
        kept, first = kept.withColumn("__leaks", leaks).filter("__leaks <= 0").select(*docs.columns), False
    return kept
