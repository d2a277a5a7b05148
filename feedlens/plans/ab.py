"""One table with every A/B comparison of the experiment notebook."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions.pvalue import t_pvalue
from feedlens.operators import experiment as ex

SUMMARY_COLS = ["test", "metric", "n_a", "n_b", "statistic", "p_value"]


def _row(df: DataFrame, test: str, metric: str, stat: str, p: str | None) -> DataFrame:
    return df.select(F.lit(test).alias("test"), F.lit(metric).alias("metric"),
                     F.col("n_a").cast("bigint").alias("n_a"), F.col("n_b").cast("bigint").alias("n_b"),
                     F.col(stat).cast("double").alias("statistic"),
                     (F.col(p) if p else F.lit(None)).cast("double").alias("p_value"))


def ab_summary(feed: DataFrame, a, b, lo, hi, alpha: float = 5.0, n_buckets: int = 50,
               n_boot: int = 2000, seed: int = 0, hash_mode: str = "xxhash64") -> DataFrame:
    """test, metric, n_a, n_b, statistic, p_value for: Welch and Mann-Whitney on
    user CTR, exact P(A > B), Welch on smoothed CTR, Welch on linearized likes
    (control = a), Poisson bootstrap of the global-CTR difference (statistic =
    mean diff, p_value as in bootstrap_summary),
    Welch and Mann-Whitney on bucket CTR."""
    groups = (a, b)
    # The per-user table feeds every test below; its shuffle is reused by all of them.
    um = ex.user_metrics(feed, groups, lo, hi)
    # the three user-level Welch tests in one aggregation pass
    wide = ex.smoothed_ctr(um, groups, alpha).withColumn(
        "linearized_likes", F.col("likes") - ex.control_ctr(um, a) * F.col("views"))
    welch = (ex.welch_stats_many(wide, ["ctr", "smoothed_ctr", "linearized_likes"], a, b)
             .withColumn("p_value", t_pvalue(F.col("t"), F.col("df")))
             .withColumn("metric", F.when(F.col("metric") == "smoothed_ctr",
                                          F.lit(f"smoothed_ctr_alpha_{alpha:g}"))
                         .otherwise(F.col("metric"))))
    ranks = ex.rank_summary(um, "ctr", a, b)   # Mann-Whitney and P(A > B): one rank table
    rows = [
        welch.select(F.lit("welch_t").alias("test"), "metric",
                     F.col("n_a").cast("bigint").alias("n_a"), F.col("n_b").cast("bigint").alias("n_b"),
                     F.col("t").alias("statistic"), "p_value"),
        _row(ranks, "mann_whitney", "ctr", "u_a", "p_value"),
        _row(ranks, "prob_a_gt_b", "ctr", "p_a_gt_b", None),
    ]
    boot = ex.bootstrap_summary(ex.bootstrap_replicates(um, a, b, n_boot, seed, hash_mode))
    sizes = um.agg(F.struct(F.count_if(F.col("exp_group") == a).alias("n_a"),
                            F.count_if(F.col("exp_group") == b).alias("n_b"))).scalar()
    rows.append(_row(boot.select("mean_diff", "p_value", sizes.getField("n_a").alias("n_a"), sizes.getField("n_b").alias("n_b")),
                     "poisson_bootstrap", "global_ctr_diff", "mean_diff", "p_value"))
    bm = ex.bucket_ratios(um, n_buckets, hash_mode)
    rows.append(_row(ex.welch_test(bm, "bucket_ctr", a, b), "welch_t", "bucket_ctr", "t", "p_value"))
    rows.append(_row(ex.mann_whitney(bm, "bucket_ctr", a, b), "mann_whitney", "bucket_ctr", "u_a", "p_value"))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
