"""Maintained first-seen tables: new users / sources / posts without rescanning
the whole event history every day (scale option for K8-K10).

``first_seen`` answers "which keys were first active on day d" from all history;
at 100 TB that is a full scan per report. The maintained form keeps one row per
key in a table partitioned by ``first_date``; the daily update reads one day of
events plus the key columns of the table (anti join), and rewrites only
partition d, so reruns are idempotent. Counting new keys on d then reads one
small partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.functions.columns import to_day
from feedlens.operators.filters import on_day
from feedlens.session import checkpoint_dir
from feedlens.sources.sinks import overwrite_partitions


def ensure_first_seen_table(spark: SparkSession, name: str, keys: list[str],
                            types: dict[str, str], location: str | None = None) -> None:
    """CREATE TABLE IF NOT EXISTS (keys..., first_date) partitioned by first_date."""
    cols = ", ".join(f"`{k}` {types[k]}" for k in keys)
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}, first_date DATE) USING parquet "
              f"OPTIONS ('partitionOverwriteMode' 'dynamic') PARTITIONED BY (first_date){loc}")


def first_seen_on(feed: DataFrame, table: DataFrame, d, keys: list[str]) -> DataFrame:
    """Keys active on day d that the table has not seen before d."""
    d = to_day(d)
    seen = table.filter(F.col("first_date") < F.lit(d)).select(*keys)
    today = on_day(feed, d).select(*keys).dropna().distinct()
    return today.join(seen, keys, "left_anti").withColumn("first_date", F.lit(d))


def update_first_seen(feed: DataFrame, name: str, d, keys: list[str]) -> None:
    """Write partition first_date = d (replacing it if present)."""
    spark = feed.sparkSession
    new = first_seen_on(feed, spark.table(name), d, keys).select(*spark.table(name).columns)
    # Materialise in the shared checkpoint folder before overwriting: the input
    # reads the same table (and a reliable checkpoint survives executor loss).
    checkpoint_dir(spark)
    overwrite_partitions(new.checkpoint(), name)


def backfill_first_seen(feed: DataFrame, name: str, up_to) -> None:
    """Initial load: every key with its first day up to ``up_to`` (one full scan)."""
    spark = feed.sparkSession
    up_to = to_day(up_to)
    keys = [c for c in spark.table(name).columns if c != "first_date"]
    first = (feed.filter(F.to_date("time") <= F.lit(up_to)).dropna(subset=keys)
             .groupBy(*keys).agg(F.min(F.to_date("time")).alias("first_date")))
    overwrite_partitions(first, name)


def count_first_seen(spark: SparkSession, name: str, d) -> DataFrame:
    """Number of keys first seen on d (reads one partition); one row."""
    return spark.table(name).filter(F.col("first_date") == F.lit(to_day(d))).agg(
        F.count("*").alias("n_new"))

