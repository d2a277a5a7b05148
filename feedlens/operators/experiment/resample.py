"""Resampling: Poisson bootstrap (T7) and the repeated-subsample A/A check.

Randomness is a hash of seed, group, index and what is drawn, never rand()/sample(),
so results do not depend on partitioning, task retries or executor loss.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions.columns import U32, hash_u32, ratio
from feedlens.functions.pvalue import t_pvalue
from feedlens.operators.experiment.draws import draw_users
from feedlens.operators.experiment.welch import welch_aggs, welch_finish

PART_USERS = 256   # like users that share one Poisson draw, at most


def poisson_thresholds(m: int) -> tuple[int, list[int]]:
    """(k0, T): a Poisson(m) draw for a uniform 32-bit h is k0 + #{T_k <= h}, with
    T_k = floor(2**32 * P(X <= k)) for k >= k0, the first k whose T_k is above 0."""
    first, out, cdf, k = None, [], 0.0, 0
    while True:
        cdf += math.exp(-m + k * math.log(m) - math.lgamma(k + 1))
        t = int(cdf * U32)
        if t and first is None:
            first = k
        if t >= U32 or (k > m and out and t == out[-1]):
            return first, out
        if t:
            out.append(t)
        k += 1


def bootstrap_replicates(um: DataFrame, a, b, n: int = 2000, seed: int = 0,
                         hash_mode: str = "xxhash64", num: str = "likes", den: str = "views",
                         group_col: str = "exp_group") -> DataFrame:
    """replicate, ctr_a, ctr_b, diff = ctr_b - ctr_a for n Poisson replicates.

    Users with the same (group, num, den) are exchangeable: the sum of their Poisson(1)
    weights is one Poisson(m) draw. So the table is first collapsed to distinct tuples with
    multiplicities (in parts of at most PART_USERS), and only those are expanded into
    replicates, each summed at once by the partial aggregate.
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    g = F.col(group_col)
    like = um.filter(g.isin(a, b)).groupBy(group_col, num, den).agg(F.count("*").alias("_m"))
    parts = (like.select("*", F.explode(F.sequence(F.lit(0), F.floor((F.col("_m") - 1) / PART_USERS).cast("int"))).alias("_part"))
             .withColumn("_m", F.least(F.lit(PART_USERS), F.col("_m") - F.col("_part") * PART_USERS).cast("int")))
    steps = {m: poisson_thresholds(m) for m in range(1, PART_USERS + 1)}
    levels = max(len(t) for _, t in steps.values()).bit_length()
    never = [U32] * (1 << levels)   # thresholds that no hash reaches: every search has the same depth
    table = um.sparkSession.createDataFrame([(m, first, (t + never)[:len(never)]) for m, (first, t) in steps.items()],
                                            "_m int, _first int, _steps array<bigint>")
    rep = (parts.join(F.broadcast(table), "_m")   # PART_USERS rows
           .select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("replicate")))
    drawn = [group_col, num, den, "_part", "replicate"]
    h = hash_u32(F.lit(seed), *drawn, mode="md5") if hash_mode == "md5" else hash_u32(*drawn, mode=hash_mode, seed=seed)
    rep = rep.withColumn("_h", h).withColumn("_reached", F.lit(0))
    for bit in reversed([1 << k for k in range(levels)]):   # binary search for the number of thresholds <= _h
        rep = rep.withColumn("_reached", F.when(F.get("_steps", F.col("_reached") + (bit - 1)) <= F.col("_h"), F.col("_reached") + bit)
                             .otherwise(F.col("_reached")))
    rep = rep.withColumn("w", F.col("_first") + F.col("_reached"))
    agg = rep.groupBy("replicate").agg(
        F.sum(F.when(g == a, F.col("w") * F.col(num))).alias("num_a"),
        F.sum(F.when(g == a, F.col("w") * F.col(den))).alias("den_a"),
        F.sum(F.when(g == b, F.col("w") * F.col(num))).alias("num_b"),
        F.sum(F.when(g == b, F.col("w") * F.col(den))).alias("den_b"))
    return agg.select("replicate", "num_a", "den_a", "num_b", "den_b",
                      ratio("num_a", "den_a").alias("ctr_a"), ratio("num_b", "den_b").alias("ctr_b"),
                      (ratio("num_b", "den_b") - ratio("num_a", "den_a")).alias("diff"))


def bootstrap_summary(reps: DataFrame) -> DataFrame:
    """One row over the replicates with a defined diff: their count, mean/min/max of diff,
    2.5 and 97.5 percentiles (linear interpolation), share of diff > 0, whether the interval
    or the whole range crosses 0 ("does not cross 0" = significant), and the two-sided
    p_value: twice the smaller of the shares on either side of 0, ties on both sides, the
    observed sample counted as one more replicate."""
    d = F.col("diff")
    s = reps.agg(F.count(d).alias("n_replicates"), F.avg(d).alias("mean_diff"),
                 F.min(d).alias("min_diff"), F.max(d).alias("max_diff"),
                 F.percentile(d, 0.025).alias("p025"), F.percentile(d, 0.975).alias("p975"),
                 F.avg(F.when(d > 0, 1.0).when(d <= 0, 0.0)).alias("share_positive"),
                 F.count_if(d <= 0).alias("_le"), F.count_if(d >= 0).alias("_ge"))
    tail = (F.lit(1.0) + F.least("_le", "_ge")) / (F.col("n_replicates") + 1)
    return (s.withColumn("ci_crosses_zero", (F.col("p025") <= 0) & (F.col("p975") >= 0))
            .withColumn("range_crosses_zero", (F.col("min_diff") <= 0) & (F.col("max_diff") >= 0))
            .withColumn("p_value", F.least(F.lit(1.0), 2 * tail)).drop("_le", "_ge"))


def aa_subsamples(um: DataFrame, a, b, n_iter: int, k: int, seed: int = 0,
                  hash_mode: str = "xxhash64", value: str = "ctr",
                  group_col: str = "exp_group") -> DataFrame:
    """iter, group, user_id, value: for each iteration, k users per group drawn without
    replacement, by index (``draws``)."""
    pop = um.filter(F.col(group_col).isin(a, b) & F.col(value).isNotNull()).select(group_col, "user_id", value)
    return draw_users(pop, a, b, n_iter, k, seed, hash_mode, group_col)


def aa_stats(um: DataFrame, a, b, n_iter: int, k: int, seed: int = 0,
             hash_mode: str = "xxhash64", value: str = "ctr",
             group_col: str = "exp_group") -> DataFrame:
    """Per iteration: iter, n_a, n_b, mean_a, mean_b, var_a, var_b, t, df."""
    draws = aa_subsamples(um, a, b, n_iter, k, seed, hash_mode, value, group_col)
    per_iter = draws.groupBy("iter").agg(*welch_aggs(value, a, b, group_col)[:6])
    return welch_finish(per_iter)


def aa_pvalues(stats: DataFrame) -> DataFrame:
    """``aa_stats`` with the p_value of every iteration."""
    return stats.withColumn("p_value", t_pvalue(F.col("t"), F.col("df")))


def aa_summary(stats: DataFrame, alpha: float = 0.05) -> DataFrame:
    """n_iter, n_significant (p < alpha), false_positive_rate, mean_p."""
    return aa_pvalues(stats).agg(
        F.count("*").alias("n_iter"),
        F.count_if(F.col("p_value") < alpha).alias("n_significant"),
        F.avg(F.when(F.col("p_value") < alpha, 1.0).otherwise(0.0)).alias("false_positive_rate"),
        F.avg("p_value").alias("mean_p"))
