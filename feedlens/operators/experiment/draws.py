"""Random draws of users by index (T3, T8): the cost is the draws', not users x draws.

Users get a dense index per group: hash buckets hold their counts, the running sum over
the buckets is each one's offset, and inside a bucket users are numbered by id. A draw is
a hash of (seed, group, iteration, j) scaled to the group's size, and one equi-join turns
places into users. Nothing depends on partitioning, task retries or executor loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.functions.columns import U32, bucket_of, hash_u32

INDEX_BUCKETS = 4096
MISS = 1e-14   # chance that an iteration's draws hold fewer than k users, at most


def user_index(pop: DataFrame, group_col: str, hash_mode: str) -> tuple[DataFrame, DataFrame]:
    """(``pop`` with ``idx`` from 0 in each group, group sizes ``n``)."""
    b = pop.withColumn("_b", bucket_of("user_id", INDEX_BUCKETS, hash_mode))
    per = b.groupBy(group_col, "_b").agg(F.count("*").alias("_c"))
    offsets = per.select(group_col, "_b", F.coalesce(F.sum("_c").over(
        Window.partitionBy(group_col).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    rn = F.row_number().over(Window.partitionBy(group_col, "_b").orderBy("user_id")) - 1
    # INDEX_BUCKETS rows per group: a proven bound, safe to broadcast
    indexed = b.withColumn("_rn", rn).join(F.broadcast(offsets), [group_col, "_b"]).select(
        *pop.columns, (F.col("_off") + F.col("_rn")).alias("idx"))
    return indexed, per.groupBy(group_col).agg(F.sum("_c").alias("n"))


def draws_needed(m, n) -> F.Column:
    """So many draws with replacement from n that fewer than m different ones have a chance
    of at most MISS: by the union bound, C(n, m-1) ((m-1)/n)**draws. For m up to n / 2 that
    is at most 2.5 m + 47."""
    less = m.cast("double") - 1
    return F.when(m <= 1, m.cast("int")).otherwise(F.ceil(less + (less - F.log(F.lit(MISS))) / -F.log(less / n)).cast("int"))


def draw_users(pop: DataFrame, a, b, n_iter: int, k: int, seed: int, hash_mode: str, group_col: str = "exp_group") -> DataFrame:
    """iter and the columns of ``pop``: k different users of each group for each iteration.

    Where k is more than half of a group, the n - k users that are left out are drawn, so the
    draws stay within a small multiple of k for every k. Fewer than k users in a group, or (chance MISS) among an iteration's draws, is an error
    of the run, never a smaller sample."""
    if n_iter < 1 or k < 1:
        raise ValueError("n_iter and k must be >= 1")
    indexed, sizes = user_index(pop, group_col, hash_mode)

    def size(g):
        n = F.coalesce(sizes.filter(F.col(group_col) == g).select("n").scalar(), F.lit(0))
        return F.when(n >= k, n).otherwise(F.raise_error(F.concat(
            F.lit(f"group {g} has "), n.cast("string"), F.lit(f" users with a defined value; cannot draw {k} without replacement"))).cast("bigint"))

    kind = pop.schema[group_col].dataType
    groups = F.array(*[F.struct(F.lit(g).cast(kind).alias(group_col), size(g).alias("n")) for g in (a, b)])
    places = (pop.sparkSession.range(n_iter).select(F.col("id").cast("int").alias("iter"), F.explode(groups).alias("g"))
              .select("iter", f"g.{group_col}", "g.n"))
    rest = 2 * F.lit(k) > F.col("n")          # then the users left out are drawn
    places = places.select("*", rest.alias("rest"), F.when(rest, F.col("n") - k).otherwise(F.lit(k).cast("bigint")).alias("m"))
    numbers = F.when(F.col("m") > 0, F.sequence(F.lit(0), draws_needed(F.col("m"), F.col("n")) - 1))
    tries = places.select("*", F.explode(numbers).alias("j"))
    h = hash_u32(F.lit(seed), group_col, "iter", "j", mode="md5") if hash_mode == "md5" else \
        hash_u32(group_col, "iter", "j", mode=hash_mode, seed=seed)
    tries = tries.withColumn("idx", (h * F.col("n") / F.lit(float(U32))).cast("bigint"))
    different = tries.groupBy("iter", group_col, "idx").agg(F.min("j").alias("j"), F.first("m").alias("m"), F.first("rest").alias("rest"))
    mine = Window.partitionBy("iter", group_col)
    rank, found = F.row_number().over(mine.orderBy("j")), F.count("*").over(mine)
    enough = F.when(found >= F.col("m"), F.lit(True)).otherwise(F.raise_error(F.lit("an iteration drew too few different users")).cast("boolean"))
    drawn = different.select("iter", group_col, "idx", "rest", "m", rank.alias("_rank"), enough.alias("_ok")).filter("_ok AND _rank <= m")
    everyone = places.filter("rest").select("iter", group_col, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("idx"))
    others = everyone.join(drawn.filter("rest"), ["iter", group_col, "idx"], "left_anti")      # at most 2 k rows an iteration and group
    taken = drawn.filter("NOT rest").select("iter", group_col, "idx").unionByName(others)
    return taken.join(indexed, [group_col, "idx"]).select("iter", *pop.columns)
