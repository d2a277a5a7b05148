"""Mann-Whitney U and probability of superiority from one rank table.

Both need, for every distinct value v, how many b-values lie strictly below v: a prefix
sum over the distinct values (a hot value is one row), see ``prefix``. NULL values are
counted in the same aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions.pvalue import exact_u_pvalue, z_pvalue
from feedlens.operators.experiment.draws import draw_users
from feedlens.operators.experiment.prefix import prefix_sums


def value_counts(df: DataFrame, value: str, a, b, group_col: str = "exp_group") -> DataFrame:
    """Distinct values v (NULL too) with n_a(v), n_b(v)."""
    g = F.col(group_col)
    return (df.filter(g.isin(a, b)).groupBy(F.col(value).cast("double").alias("v"))
            .agg(F.count_if(g == a).alias("na"), F.count_if(g == b).alias("nb")))


def rank_table(df: DataFrame, value: str, a, b, group_col: str = "exp_group") -> DataFrame:
    """Distinct values v with n_a(v), n_b(v) and b_below(v) = #{b-values < v}; the NULL
    values as one row without b_below."""
    vals = value_counts(df, value, a, b, group_col)
    return prefix_sums(vals, "v", "nb", out="b_below").unionByName(
        vals.filter("v IS NULL").withColumn("b_below", F.lit(None).cast("bigint")))


def _rank_sums(rt: DataFrame) -> DataFrame:
    known = F.col("v").isNotNull()
    na, nb, below = (F.when(known, F.col(c)).cast("double") for c in ("na", "nb", "b_below"))
    t = na + nb
    return rt.agg(F.coalesce(F.sum(F.when(known, F.col("na"))), F.lit(0)).alias("n_a"),
                  F.coalesce(F.sum(F.when(known, F.col("nb"))), F.lit(0)).alias("n_b"),
                  F.coalesce(F.sum(F.when(~known, F.col("na") + F.col("nb"))), F.lit(0)).alias("n_undefined"),
                  F.sum(na * (below + nb / 2)).alias("u_a"),
                  F.sum(na * below).alias("a_gt"), F.sum(na * nb).alias("ties"),
                  F.sum(t * t * t - t).alias("tie_term"))


def _mw_columns():
    n1, n2 = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    n = n1 + n2
    u_b = n1 * n2 - F.col("u_a")
    sigma = F.sqrt(n1 * n2 / 12 * ((n + 1) - F.try_divide(F.col("tie_term"), n * (n - 1))))
    z = F.try_divide(F.greatest(F.col("u_a"), u_b) - n1 * n2 / 2 - 0.5, sigma)
    return [F.col("n_a"), F.col("n_b"), F.col("u_a"), u_b.alias("u_b"), F.col("tie_term"), z.alias("z")]


EXACT_GROUP = 8            # with a group of at most this size and no ties, p is exact
EXACT_PAIRS = 100_000      # n_a * n_b up to which the exact counts are formed


def _with_pvalue(stats: DataFrame) -> DataFrame:
    """Adds ``method`` and the two-sided p_value. The null distribution is counted out (exact)
    where the smaller group is small and there are no ties, as common statistics libraries
    choose; else it is the normal approximation with continuity and tie correction."""
    small = (F.least("n_a", "n_b") <= EXACT_GROUP) & (F.col("n_a") * F.col("n_b") <= EXACT_PAIRS)
    exact = small & (F.col("tie_term") == 0)
    z = F.when(~exact, F.col("z"))          # each tail is computed only where it is the one
    n_a, n_b, u_a = (F.when(exact, F.col(c)) for c in ("n_a", "n_b", "u_a"))
    p = F.when(exact, exact_u_pvalue(n_a, n_b, u_a)).when(F.col("z") < 0, F.lit(1.0)).otherwise(z_pvalue(z))
    return stats.withColumn("p_value", p).withColumn("method", F.when(exact, "exact").otherwise("asymptotic"))


def _superiority_columns():
    pairs = F.col("n_a").cast("double") * F.col("n_b").cast("double")
    gt = F.try_divide(F.col("a_gt"), pairs)
    tie = F.try_divide(F.col("ties"), pairs)
    return [gt.alias("p_a_gt_b"), tie.alias("p_tie"), (F.lit(1.0) - gt - tie).alias("p_a_lt_b")]


def rank_summary(df: DataFrame, value: str, a, b, group_col: str = "exp_group") -> DataFrame:
    """Mann-Whitney (with p_value) and exact P(A > B) from one rank table; one row."""
    s = _rank_sums(rank_table(df, value, a, b, group_col))
    return _with_pvalue(s.select(*_mw_columns(), *_superiority_columns(), "n_undefined"))


def mann_whitney_stats(df: DataFrame, value: str, a, b, group_col: str = "exp_group") -> DataFrame:
    """n_a, n_b, u_a (U of group a), u_b, tie_term, z (two-sided, continuity 0.5),
    n_undefined (NULL values left out)."""
    return _rank_sums(rank_table(df, value, a, b, group_col)).select(*_mw_columns(), "n_undefined")


def mann_whitney(df: DataFrame, value: str, a, b, group_col: str = "exp_group") -> DataFrame:
    """mann_whitney_stats plus the two-sided p_value and its ``method`` (exact or asymptotic)."""
    return _with_pvalue(mann_whitney_stats(df, value, a, b, group_col))


def prob_superiority(df: DataFrame, value: str, a, b, group_col: str = "exp_group", n_pairs: int | None = None,
                     seed: int = 0, hash_mode: str = "xxhash64") -> DataFrame:
    """P(A > B), P(A = B), P(A < B) for a random a-value against a random b-value.

    Default: exact, over all (a, b) pairs. ``n_pairs``: the Monte-Carlo estimate of
    the source notebook instead -- each pair draws one user per group, by index, so its
    cost is that of the pairs, not of users x pairs.
    """
    if n_pairs:
        g, v = F.col(group_col), F.col(value)
        pop = df.filter(g.isin(a, b) & v.isNotNull()).select(group_col, "user_id", value)
        drawn = draw_users(pop, a, b, n_pairs, 1, seed, hash_mode, group_col)
        pairs = drawn.groupBy("iter").agg(F.max(F.when(g == a, v)).alias("va"), F.max(F.when(g == b, v)).alias("vb"))
        frac = lambda c: F.avg(F.when(c, 1.0).otherwise(0.0))
        return pairs.agg(F.count("*").alias("n_pairs"),
                         frac(F.col("va") > F.col("vb")).alias("p_a_gt_b"),
                         frac(F.col("va") == F.col("vb")).alias("p_tie"),
                         frac(F.col("va") < F.col("vb")).alias("p_a_lt_b"))
    return _rank_sums(rank_table(df, value, a, b, group_col)).select("n_a", "n_b", *_superiority_columns(), "n_undefined")
