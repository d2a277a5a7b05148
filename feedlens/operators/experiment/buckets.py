"""Bucket transform of per-user metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions.columns import bucket_of, ratio
from feedlens.functions.xxh64 import xxh64_bucket
from feedlens.operators.experiment.metrics import user_metrics
from feedlens.operators.experiment.prefix import prefix_sums


def index_quantile(df: DataFrame, keys: list[str], value: str, q: float, out: str = "quantile") -> DataFrame:
    """Exact non-interpolated quantile per key: the sorted value at 0-based index
    min(floor(q*n), n-1), NULLs skipped (A8).

    Works on (key, value) counts, so a frequent value is one row; the position of each
    distinct value within its key is a prefix sum (``prefix``), not one task per key.
    """
    counts = (df.filter(F.col(value).isNotNull())
              .groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_c")))
    run = prefix_sums(counts, "_v", "_c", tuple(keys), "_before", "_n")
    idx = F.least(F.floor(F.lit(q) * F.col("_n")), F.col("_n") - 1)
    return (run.filter((F.col("_before") <= idx) & (idx < F.col("_before") + F.col("_c")))
            .select(*keys, F.col("_v").cast(df.schema[value].dataType).alias(out)))


def with_bucket(um: DataFrame, n_buckets: int, hash_mode: str = "xxhash64") -> DataFrame:
    """``um`` with the users' hash ``bucket``. Modes 'xxh64' and 'xxh64_32' give the very ids
    that ``xxHash64(user_id) % n`` gives over 64-bit and 32-bit ids in engines with seed 0."""
    if hash_mode in ("xxh64", "xxh64_32"):
        return um.withColumn("bucket", xxh64_bucket("user_id", n_buckets, 8 if hash_mode == "xxh64" else 4))
    return um.withColumn("bucket", bucket_of("user_id", n_buckets, hash_mode))


def bucket_user_metrics(feed: DataFrame, groups, lo, hi, n_buckets: int = 50,
                        hash_mode: str = "xxhash64") -> DataFrame:
    """Per-user metrics with their hash bucket."""
    return with_bucket(user_metrics(feed, groups, lo, hi), n_buckets, hash_mode)


def bucket_metrics(feed: DataFrame, groups, lo, hi, n_buckets: int = 50, q: float = 0.9,
                   hash_mode: str = "xxhash64") -> DataFrame:
    """exp_group, bucket, bucket_ctr = sum(likes)/sum(views), ctr9 = exact q-quantile
    of user ctr in the bucket (T5).

    Bucket ids come from Spark's xxhash64 by default, from ``with_bucket``'s other modes for
    a portable hash or for the ids of other engines; any gives a valid random partition.
    """
    return bucket_metrics_from_users(user_metrics(feed, groups, lo, hi), n_buckets, q, hash_mode)


def bucket_ratios(um: DataFrame, n_buckets: int = 50, hash_mode: str = "xxhash64") -> DataFrame:
    """exp_group, bucket, bucket_ctr = sum(likes)/sum(views) per bucket (A7): all a
    bucket-level t-test or Mann-Whitney test needs."""
    if n_buckets < 1:
        raise ValueError("n_buckets must be >= 1")
    ub = with_bucket(um, n_buckets, hash_mode)
    return ub.groupBy("exp_group", "bucket").agg(ratio(F.sum("likes"), F.sum("views")).alias("bucket_ctr"))


def bucket_metrics_from_users(um: DataFrame, n_buckets: int = 50, q: float = 0.9,
                              hash_mode: str = "xxhash64") -> DataFrame:
    """bucket_metrics over an existing per-user table (exp_group, user_id, likes, views, ctr)."""
    if n_buckets < 1 or not 0.0 <= q <= 1.0:
        raise ValueError("need n_buckets >= 1 and 0 <= q <= 1")
    ub = with_bucket(um, n_buckets, hash_mode)
    keys = ["exp_group", "bucket"]
    ratio_part = bucket_ratios(um, n_buckets, hash_mode)
    q_part = index_quantile(ub, keys, "ctr", q, "ctr9")
    return ratio_part.join(q_part, keys, "left").select(*keys, "bucket_ctr", "ctr9")
