"""Approximate nearest neighbours by learned partitions.

On a bounded sample the graph of nearest neighbours is built and cut into parts of equal
size: bisected again and again by the smooth direction of its random walk, each time at the
median, and mended by swaps that cut fewer edges. A small classifier (one hidden layer)
then learns from a vector alone in which parts its neighbours lie. It places every row of
the table in its most probable part and sends a query to its several most probable ones;
how many is measured on held-out sample rows, for the recall asked for. What is found there
is reranked by the exact cosine of the original vectors in double precision.

Parts and their queries are cut into blocks of bounded size, so a part that holds a third
of all rows (copies of one vector) is spread over as many tasks as it has blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.functions import arrow_udf

from feedlens.llm.common import materialise, read_table

K = 5
SAMPLE, SAMPLE_BYTES = 16_384, 64 << 20    # rows to fit on, and their bytes in double precision
PART_ROWS = 64                             # sample rows a part, at least
GRAPH_DEGREE, HIDDEN, EPOCHS = 10, 128, 24
TARGET_RECALL = 0.97                       # on held-out sample rows; asked for are 0.9 of the table
HELD_OUT = 1_000
BLOCK_BYTES = 16 << 20                     # rows, or queries, of a block in double precision
_SLICE = 1 << 21                           # products in memory at a time


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest number near one: exact, and no
    square overflows or vanishes."""
    x = np.asarray(x, np.float64)
    if not x.size:
        return x
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _near(rows: np.ndarray, units: np.ndarray, k: int, own: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """Places in ``units`` of the k nearest of each row, some rows at a time; ``own`` are the
    rows' own places, which don't count."""
    step = max(1, _SLICE // max(1, len(units)))
    for a in range(0, len(rows), step):
        s = rows[a:a + step] @ units.T
        if own is not None:
            s[np.arange(len(s)), own[a:a + step]] = -np.inf
        yield np.argpartition(-s, k - 1, axis=1)[:, :k]


def neighbour_graph(spark: SparkSession, units: np.ndarray, k: int = GRAPH_DEGREE) -> np.ndarray:
    """Row i: places of the k nearest of row i in the bounded sample, found in Spark tasks."""
    n = len(units)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            at = rows["id"].to_numpy()
            found = np.concatenate(list(_near(units[at], units, k, at)))
            yield pd.DataFrame({"id": at, "near": list(found)})

    rows = spark.range(0, n, 1, max(1, n // 1024)).mapInPandas(work, "id long, near array<long>").collect()
    return np.array([r["near"] for r in sorted(rows, key=lambda r: r["id"])], np.int64)


def _halves(u: np.ndarray, v: np.ndarray, part: np.ndarray, rng, steps: int = 50) -> np.ndarray:
    """Cuts every part in two halves along the slowest direction of the random walk inside it."""
    n = len(part)
    degree = np.maximum(np.bincount(u, minlength=n), 1.0)
    weight = np.bincount(part, degree)
    x = rng.standard_normal(n)
    for _ in range(steps):
        x = (x + np.bincount(u, x[v], n) / degree) / 2
        x -= (np.bincount(part, x * degree) / weight)[part]
        x /= np.sqrt(np.bincount(part, x * x) + 1e-300)[part]
    order = np.lexsort((x, part))
    sizes = np.bincount(part)
    place = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    half = np.empty(n, bool)
    half[order] = place >= (sizes // 2)[part[order]]
    return half


def _swapped(u: np.ndarray, v: np.ndarray, part: np.ndarray, half: np.ndarray, rounds: int = 12) -> np.ndarray:
    """Halves with fewer cut edges: the rows that gain most change sides in pairs, so the
    sizes stay; as long as the cut shrinks."""
    members = np.split(np.argsort(part, kind="stable"), np.cumsum(np.bincount(part))[:-1])
    cut = int((half[u] != half[v]).sum())
    for _ in range(rounds):
        gain = np.bincount(u, np.where(half[u] != half[v], 1.0, -1.0), len(part))
        tried = half.copy()
        for rows in members:
            sides = [rows[half[rows] == s] for s in (False, True)]
            left, right = (side[np.argsort(-gain[side], kind="stable")] for side in sides)
            m = min(len(left), len(right))
            good = int(((gain[left[:m]] + gain[right[:m]]) > 0).sum())
            m = (good + 1) // 2           # pairs that swap at once disturb each other's gains
            tried[left[:m]], tried[right[:m]] = True, False
        now = int((tried[u] != tried[v]).sum())
        if now >= cut:
            break
        half, cut = tried, now
    return half


def balanced_parts(near: np.ndarray, parts: int) -> np.ndarray:
    """The part of each row of a neighbour graph, cut into ``parts`` (a power of two) parts
    whose sizes differ by one at most for each bisection."""
    n = len(near)
    a, b = np.repeat(np.arange(n), near.shape[1]), near.ravel()
    u, v = np.concatenate((a, b)), np.concatenate((b, a))
    part, rng = np.zeros(n, np.int64), np.random.default_rng(11)
    while parts > 1:
        inside = part[u] == part[v]
        u, v = u[inside], v[inside]
        part = 2 * part + _swapped(u, v, part, _halves(u, v, part, rng))
        parts //= 2
    return part


@dataclass
class Router:
    """Probabilities of parts from a vector: one hidden layer, softmax."""

    layers: list[np.ndarray]
    parts: int

    def scores(self, units: np.ndarray) -> np.ndarray:
        if self.parts == 1:
            return np.zeros((len(units), 1))
        w1, b1, w2, b2 = self.layers
        return np.maximum(units @ w1 + b1, 0.0) @ w2 + b2

    def order(self, units: np.ndarray) -> np.ndarray:
        """Parts from the most probable on."""
        return np.argsort(-self.scores(units), axis=1, kind="stable")


def train_router(units: np.ndarray, near: np.ndarray, part: np.ndarray, parts: int, epochs: int = EPOCHS, batch: int = 256) -> Router:
    """Cross entropy against the share of each part among a row and its neighbours, by Adam."""
    rng = np.random.default_rng(12)
    n, d = units.shape
    w = [rng.standard_normal((d, HIDDEN)) * 2 ** 0.5, np.zeros(HIDDEN),
         rng.standard_normal((HIDDEN, parts)) / HIDDEN ** 0.5, np.zeros(parts)]
    if parts == 1:
        return Router(w, 1)
    first, second = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]
    around = np.concatenate((part[:, None], part[near]), axis=1)
    step, total = 0, epochs * -(-n // batch)
    for _ in range(epochs):
        order = rng.permutation(n)
        for a in range(0, n, batch):
            at = order[a:a + batch]
            x = units[at]
            want = np.zeros((len(at), parts))
            np.add.at(want, (np.arange(len(at))[:, None], around[at]), 1.0 / around.shape[1])
            hidden = np.maximum(x @ w[0] + w[1], 0.0)
            out = hidden @ w[2] + w[3]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            error = (out / out.sum(axis=1, keepdims=True) - want) / len(at)
            back = (error @ w[2].T) * (hidden > 0)
            step += 1
            rate = 0.004 * (1 - step / (total + 1))
            for k, g in enumerate((x.T @ back, back.sum(0), hidden.T @ error, error.sum(0))):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                w[k] = w[k] - rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return Router(w, parts)


def probes_needed(router: Router, held: np.ndarray, units: np.ndarray, k: int, target: float) -> tuple[int, float]:
    """How many parts have to be searched so that this share of the k nearest sample rows of
    held-out rows is found, and the share found. The table's own neighbours are nearer than
    the sample's, so they are found rather more often."""
    k = min(k, len(units))
    if router.parts == 1 or not len(held) or not k:
        return router.parts, 1.0
    at = router.order(units)[:, 0]
    rank = np.argsort(router.order(held), axis=1)      # rank[i, p]: when part p is searched
    near = np.concatenate(list(_near(held, units, k)))
    when = np.take_along_axis(rank, at[near], axis=1)
    found = np.cumsum(np.bincount(when.ravel(), minlength=router.parts)) / when.size
    probes = int(np.searchsorted(found, target) + 1)
    return min(probes, router.parts), float(found[min(probes, router.parts) - 1])


def fit_partitions(spark: SparkSession, sample: np.ndarray, k: int = K, target: float = TARGET_RECALL) -> tuple[Router, int, float]:
    """Router, parts to search and held-out recall from a bounded sample of vectors."""
    units = unit_rows(sample)
    held = min(HELD_OUT, len(units) // 10)
    test, units = units[:held], units[held:]
    parts = 1
    while len(units) >= 2 * parts * PART_ROWS:
        parts *= 2
    if parts == 1:
        return Router([], 1), 1, 1.0
    near = neighbour_graph(spark, units)
    router = train_router(units, near, balanced_parts(near, parts), parts)
    return router, *probes_needed(router, test, units, k, target)


def usable_vectors(table: DataFrame, vec_id: str, vector: str) -> tuple[DataFrame, int]:
    """Rows (__row, vec_id, vec) that take part, written to the shared folder, and their
    dimension. Vectors that are null, empty, zero or hold a null or non-finite number take no
    part; nor do those that haven't the commonest length (of equally common ones the longer)."""
    v = F.col(vector)
    rows = (table.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("vec"))
            .filter((F.size("vec") > 0) & F.forall("vec", lambda x: x.isNotNull()))
            .filter(F.forall("vec", lambda x: ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("vec", lambda x: x != 0)))
    rows = materialise(rows.select(F.monotonically_increasing_id().alias("__row"), "vec_id", "vec"), "vectors")
    common = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if common is None:
        return rows, 0
    return rows.filter(F.size("vec") == common["d"]), int(common["d"])


def _sample(rows: DataFrame, dim: int) -> np.ndarray:
    """A bounded sample, the same however the rows are laid out: the smallest hashes of
    (vec_id, vector)."""
    bound = max(2, min(SAMPLE, SAMPLE_BYTES // (8 * dim)))
    n = rows.count()
    keyed = rows.select("vec_id", "vec", F.xxhash64(F.lit(11), "vec_id", "vec").alias("__h"))
    if n > 2 * bound:
        keyed = keyed.filter(F.pmod("__h", F.lit(1 << 30)) < int((1 << 30) * 2 * bound / n))
    taken = keyed.orderBy("__h", "vec_id", "vec").limit(bound).select("vec").collect()
    return np.array([r["vec"] for r in taken], np.float64).reshape(-1, dim)


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _place_udf(router: Router, dim: int):
    """UDF: vector -> its most probable part."""
    @arrow_udf("int")
    def place(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in batches:
            yield pa.array(router.order(unit_rows(_vectors(vectors, dim)))[:, 0], pa.int32())

    return place


def _route_udf(router: Router, dim: int, probes: int, sizes: np.ndarray, least: int):
    """UDF: vector -> the parts to search: ``probes``, and more until they hold ``least`` rows."""
    @arrow_udf("array<int>")
    def route(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in batches:
            order = router.order(unit_rows(_vectors(vectors, dim)))
            enough = np.cumsum(sizes[order], axis=1) >= least
            n = np.where(enough.any(axis=1), enough.argmax(axis=1) + 1, router.parts)
            n = np.maximum(n, probes)
            yield pa.array([o[:m] for o, m in zip(order.astype(np.int32), n.tolist())], pa.list_(pa.int32()))

    return route


def _nearest(rows: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """Each query's k nearest in a block, ties to the smaller id, by exact cosines: the
    products only choose the rows that can be among them."""
    out = []
    if len(rows) and len(queries):
        v, q = (scaled(np.stack(x["vec"].to_numpy())) for x in (rows, queries))
        nv, nq = (np.sqrt((x * x).sum(axis=1)) for x in (v, q))
        uv, uq = v / nv[:, None], q / nq[:, None]
        ids, row, asked = (x.to_numpy() for x in (rows["__tie"], rows["__row"], queries["__row"]))
        step = max(1, _SLICE // len(v))
        for a in range(0, len(q), step):
            s = uq[a:a + step] @ uv.T
            s[asked[a:a + step, None] == row[None, :]] = -np.inf
            m = min(k, len(v))
            edge = np.partition(s, len(v) - m, axis=1)[:, len(v) - m]
            for i in range(len(s)):
                c = np.flatnonzero((s[i] >= edge[i] - 1e-9) & (s[i] > -np.inf))
                exact = (v[c] * q[a + i]).sum(axis=1) / (nv[c] * nq[a + i])
                best = np.lexsort((row[c], ids[c], -exact))[:k]
                out.append(pd.DataFrame({"__query": asked[a + i], "__at": row[c[best]], "score": exact[best]}))
    found = pd.concat(out) if out else pd.DataFrame({"__query": [], "__at": [], "score": []})
    return found.astype({"__query": "int64", "__at": "int64", "score": "float64"})


def _pick(values: list[int], part: str) -> Column:
    """values[part]; at most one number for each part."""
    return F.element_at(F.lit([int(x) for x in values]), F.col(part) + 1)


def nearest_neighbours(table: DataFrame, is_query: Column | None = None, vec_id: str = "vec_id", vector: str = "embedding", k: int = K,
                       target: float = TARGET_RECALL) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's k nearest found, by largest
    cosine, ties to the smaller vec_id (null last).

    Queries are the rows of ``table`` for which ``is_query`` holds (a column over ``vec_id``;
    None: all rows); candidates are all rows but the query's own. Rows with a vector that
    can't be compared take no part (``usable_vectors``); repeated ids and null ids are rows of
    their own; a table without usable vectors gives no rows. Other columns are not read."""
    spark = table.sparkSession
    rows, dim = usable_vectors(table, vec_id, vector)
    if not dim:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    router, probes, _ = fit_partitions(spark, _sample(rows, dim), k, target)
    placed = materialise(rows.withColumn("__part", _place_udf(router, dim)("vec")), "placed")
    sizes = np.zeros(router.parts, np.int64)
    for r in placed.groupBy("__part").count().collect():       # one row a part
        sizes[r["__part"]] = r["count"]
    asked = placed if is_query is None else placed.filter(is_query)
    route = _route_udf(router, dim, probes, sizes, k + 1)
    asked = materialise(asked.select("__row", "vec", F.explode(route("vec")).alias("__part")), "routed")
    wanted = np.zeros(router.parts, np.int64)
    for r in asked.groupBy("__part").count().collect():
        wanted[r["__part"]] = r["count"]
    block = max(1, BLOCK_BYTES // (8 * dim))
    row_blocks, query_blocks = np.maximum(1, -(-sizes // block)), np.maximum(1, -(-wanted // block))

    def blocked(df: DataFrame, own: list, own_name: str, others: list, other_name: str) -> DataFrame:
        """Rows in a block of their own part, once for each block of the other side."""
        mine = F.pmod(F.xxhash64("__row"), _pick(own, "__part")).cast("int").alias(own_name)
        each = F.explode(F.sequence(F.lit(0), _pick(others, "__part") - 1)).alias(other_name)
        return df.select("*", mine, each)

    key = ["__part", "__rows", "__queries"]
    left = blocked(placed, row_blocks, "__rows", query_blocks, "__queries").filter(_pick(wanted, "__part") > 0)
    right = blocked(asked, query_blocks, "__queries", row_blocks, "__rows")

    def work(key, rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        return _nearest(rows, queries, k)

    tie = F.coalesce("vec_id", F.lit((1 << 63) - 1)).alias("__tie")    # null ids last
    found = (left.select("__row", tie, "vec", *key).groupBy(*key).cogroup(right.select("__row", "vec", *key).groupBy(*key))
             .applyInPandas(work, "__query long, __at long, score double"))
    ids = placed.select(F.col("__row").alias("__at"), "vec_id")
    names = placed.select(F.col("__row").alias("__query"), F.col("vec_id").alias("query_id"))
    order = W.partitionBy("__query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "__at")
    return (found.join(ids, "__at").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .join(names, "__query").select("query_id", "rank", "vec_id", "score"))


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
