"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints of 64 bits link at ``radius`` (2) or fewer differing bits. The bits are cut
into six blocks; two differing bits touch at most two of them, so linked fingerprints
agree on the other four for one of 15 choices, which makes 15 exact buckets of at
least 42 shared bits. A bucket of over ``SPLIT`` distinct fingerprints is cut again in the
same way by its other 22 bits, into ten buckets of which none can hold over 2**10 and which
go to different tasks, so no bucket's work grows with its square. Inside, bit planes are stored vertically (one bit a member, 64
members a word); shifted by s they are compared with themselves, so one XOR updates 64
distances, a two-bit carry-save counter with overflow adds up, and words in which every
pair has overflowed are abandoned. Only a spanning forest of a bucket's links is
emitted; components follow from the forests by alternating star contraction.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from feedlens.llm.common import materialise, read_table, text_udf, with_row_key

SHINGLE, RADIUS, BLOCKS = 3, 2, 6
SPLIT, SPLIT_BLOCKS = 4_096, 5    # fingerprints of a bucket that is compared whole; blocks of a larger one's other bits
_ONE = np.uint64(1)
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """The unsigned 64-bit SimHash of a text's word shingles; 0 without a word."""
    words = (text or "").encode().lower().split()  # bytes: ASCII case and white space only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        hashes = xxhash.xxh64_digest(joined, 42)
        count = 1
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        count = len(words) - width + 1
        digest = xxhash.xxh64_digest
        hashes = b"".join([digest(joined[a:b], 42)
                           for a, b in zip(starts[:count].tolist(), ends[width - 1:].tolist())])
    rows = np.frombuffer(hashes, np.uint8).reshape(count, 8)
    bits = np.concatenate([np.bincount(rows[:, k], minlength=256) @ _BYTE_BITS for k in range(8)])
    return int.from_bytes(np.packbits(2 * bits > count).tobytes(), "big")


def fingerprints(width: int = SHINGLE):
    """UDF: text -> fingerprint as a signed long."""

    def simhash(texts: list[str | None]) -> np.ndarray:
        return np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64)

    return text_udf("long", lambda: simhash)


def bucket_masks(radius: int = RADIUS, blocks: int = BLOCKS) -> list[int]:
    """Masks of the bits that a bucket shares: all blocks but ``radius`` of them."""
    edges = [64 * k // blocks for k in range(blocks + 1)]
    block = [((1 << edges[k + 1]) - 1) ^ ((1 << edges[k]) - 1) for k in range(blocks)]
    return [((1 << 64) - 1) ^ sum(block[k] for k in gone) for gone in combinations(range(blocks), radius)]


def split_masks(mask: int, radius: int = RADIUS, blocks: int = SPLIT_BLOCKS) -> list[int]:
    """``mask`` with all but ``radius`` of the blocks of the other bits: two values that agree
    in ``mask`` and are within ``radius`` agree in one of these."""
    other = [p for p in range(64) if not mask >> p & 1]
    block = [sum(1 << p for p in other[len(other) * k // blocks:len(other) * (k + 1) // blocks]) for k in range(blocks)]
    return [((1 << 64) - 1) ^ sum(block[k] for k in gone) for gone in combinations(range(blocks), radius)]


def _planes(values: np.ndarray) -> np.ndarray:
    """64 bit planes of the values, each as words of 64 members, one word spare."""
    n = len(values)
    words = (n + 63) // 64 + 1
    bits = np.zeros((64, words * 64), np.uint8)
    for p in range(64):
        bits[p, :n] = (values >> np.uint64(p)) & _ONE
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def _shifted(planes: np.ndarray, words: np.ndarray, s: int) -> np.ndarray:
    """``words`` of the planes moved down by ``s`` members."""
    q, r = divmod(s, 64)
    last = planes.shape[-1] - 1
    low = planes[..., np.minimum(words + q, last)]
    if not r:
        return low
    return (low >> np.uint64(r)) | (planes[..., np.minimum(words + q + 1, last)] << np.uint64(64 - r))


def linked_pairs(values: np.ndarray, bucket: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, i + s) of one bucket within ``radius`` (at most 2), for s = 1, 2, ...

    ``bucket`` numbers each member's bucket, in ascending order."""
    n, planes = len(values), _planes(values)
    for s in range(1, n):
        same = bucket[s:] == bucket[:-s]
        if not same.any():
            return
        lanes = np.zeros((planes.shape[1]) * 64, np.uint8)
        lanes[:n - s] = same
        valid = np.packbits(lanes, bitorder="little").view(np.uint64)
        live = np.flatnonzero(valid)
        valid = valid[live]
        ones = np.zeros(len(live), np.uint64)
        twos, over = ones.copy(), ~valid
        for first in range(0, 64, 8):
            here = planes[first:first + 8]
            for d in here[:, live] ^ _shifted(here, live, s):
                carry = ones & d
                ones ^= d
                over |= twos & carry
                twos ^= carry
            beyond = over | (twos & ones if radius == 2 else twos if radius == 1 else twos | ones)
            keep = beyond != ~np.uint64(0)
            if not keep.all():  # blocks where all pairs exceed the radius are abandoned
                live, ones, twos, over, beyond = live[keep], ones[keep], twos[keep], over[keep], beyond[keep]
            if not len(live):
                break
        if len(live):
            hit = np.unpackbits((~beyond).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, lane = np.nonzero(hit.reshape(len(live), 64))
            i = live[row] * 64 + lane
            yield i, i + s


def forest(values: np.ndarray, bucket: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links inside buckets, as two value arrays."""
    root = np.arange(len(values))
    left, right = [], []
    for i, j in linked_pairs(values, bucket, radius):
        fresh = root[i] != root[j]
        for a, b in zip(i[fresh].tolist(), j[fresh].tolist()):
            x, y = a, b
            while root[x] != x:
                x = root[x]
            while root[y] != y:
                y = root[y]
            if x != y:
                root[max(x, y)] = min(x, y)
                left.append(a)
                right.append(b)
        while (root[root] != root).any():
            root = root[root]
    return values[left], values[right]


def _bucket_links(radius: int):
    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.empty((0, 3), np.int64)
        for batch in batches:
            rows = np.concatenate([held, batch[["t", "key", "fp"]].to_numpy(np.int64)])
            whole = len(rows)  # rows of the last bucket wait for the next batch
            if whole:
                whole = int(np.argmax((rows[:, :2] == rows[-1, :2]).all(axis=1)))
            held, rows = rows[whole:], rows[:whole]
            yield from _forest_frame(rows, radius)
        yield from _forest_frame(held, radius)

    return links


def _forest_frame(rows: np.ndarray, radius: int) -> Iterator[pd.DataFrame]:
    if len(rows) < 2:
        return
    new = np.concatenate(([True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)))
    bucket = np.cumsum(new)
    several = np.bincount(bucket)[bucket] > 1
    if several.any():
        u, v = forest(rows[several, 2].view(np.uint64), bucket[several], radius)
        yield pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (u, v) among distinct fingerprints in column ``fp``: enough of them to
    connect every pair within ``radius``, at most one less than its members a bucket."""
    masks = bucket_masks(radius)

    def keyed(numbered: list[tuple[int, int]]):
        return F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for t, m in numbered])

    buckets = distinct.select("fp", F.explode(keyed(list(enumerate(masks)))).alias("k")).select("k.t", "k.key", "fp")
    large = materialise(buckets.groupBy("t", "key").agg(F.count("*").alias("n")).filter(F.col("n") > SPLIT), "large_buckets")
    if not large.isEmpty():
        sizes = large.select("t", "key", F.lit(True).alias("large"))
        marked = buckets.join(sizes, ["t", "key"], "left")
        finer = F.element_at(F.array(*[keyed([(1000 * (t + 1) + k, f) for k, f in enumerate(split_masks(m, radius))])
                                       for t, m in enumerate(masks)]), F.col("t") + 1)
        kept = marked.filter("large IS NULL").select("t", "key", "fp")
        buckets = kept.unionByName(marked.filter("large").select("fp", F.explode(finer).alias("k")).select("k.t", "k.key", "fp"))
    return (buckets.repartition("t", "key").sortWithinPartitions("t", "key", "fp")
            .mapInPandas(_bucket_links(radius), "u long, v long").distinct())


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (u, v); component: its smallest node.

    Alternating large-star and small-star steps: each moves edges toward the smallest
    neighbour until every node hangs on its component's smallest. A step is one
    aggregate and one join, so no neighbourhood is ever gathered in one place; the edges
    are written to the shared folder after each round."""
    edges = materialise(links.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: u's larger neighbours hang on the smallest of u and its neighbours
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = materialise(small.filter("u > v").distinct(), "edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    hung = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return hung.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def simhash_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                       row_id: str | None = None, width: int = SHINGLE, radius: int = RADIUS, component: str | None = None) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id (and row_id).

    ``component`` names a column for the component itself, its smallest fingerprint as a
    signed long: never null, and told apart where component_ids are null or repeat.

    component_id is the smallest doc_id reachable over links. Null and empty texts have
    fingerprint zero and link like any other. Null doc_ids are never a component_id
    unless the component has no other. Repeated rows stay. An empty table gives no rows.
    """
    if radius not in (0, 1, 2):
        raise ValueError("the carry-save counters hold radii of 0 to 2")
    row = [F.col(row_id).alias("__row")] if row_id else []
    prints = materialise(docs.select(F.col(doc_id).alias("doc_id"), *row,
                                     fingerprints(width)(F.col(text)).alias("fp")), "prints")
    distinct = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    joined = materialise(components(fingerprint_links(distinct.select("fp"), radius)), "components")
    owned = distinct.join(joined, distinct["fp"] == joined["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    smallest = owned.groupBy("component").agg(F.min("least").alias("component_id"))
    by_print = owned.join(smallest, "component").select("fp", "component_id", "component")
    out = prints.join(by_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", *(["__row"] if row_id else []),
        *([F.col("component").alias(component)] if component else []))
    return out.withColumnRenamed("__row", row_id) if row_id else out


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(read_table(spark, sf_dir, "documents"))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` with one row of each component: the smallest doc_id (of repeated rows one)."""
    keyed = with_row_key(docs)
    found = materialise(simhash_components(keyed, row_id="__doc_row", component="__component"), "near")
    first = found.groupBy("__component").agg(
        F.count("*").alias("n"),
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", F.col("__doc_row").alias("row"))).alias("first")) \
        .filter("n > 1").select("__component", F.col("first.row").alias("stays"))
    dropped = found.join(first, "__component").filter(F.col("__doc_row") != F.col("stays")).select("__doc_row")
    return keyed.join(dropped, "__doc_row", "left_anti").select(*docs.columns)
