"""Distinct users from stored, mergeable sketches.

An hour's users of a service are kept as one HyperLogLog sketch in a table partitioned by
day. Sketches of any hours, days and services merge into the sketch of their union, so
day and week figures cost a few rows an hour instead of another pass over the events.
The standard error is 1.04 / sqrt(2 ** log2k), 0.8 % at the default; a sketch of few users
(about 1,500 at the default) still lists them and counts them one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.functions.columns import slot_start, to_day
from feedlens.operators.filters import between_dates
from feedlens.operators.kpi import SKETCH_LOG2
from feedlens.sources.sinks import ensure_table, overwrite_partitions, replace_partition


def ensure_hourly_sketches(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Table (service, hour, users; by event_date)."""
    ensure_table(spark, name, "service STRING, hour TIMESTAMP_NTZ, users BINARY, event_date DATE", ["event_date"], location)


def hourly_sketches(feed: DataFrame, msgs: DataFrame, lo, hi=None, log2k: int = SKETCH_LOG2) -> DataFrame:
    """event_date, service, hour, users (sketch) of the days lo..hi; NULL users are no users.
    Partial sketches are built in the map tasks, so a hot hour shuffles a sketch a task."""
    hi = lo if hi is None else hi
    both = [between_dates(df, lo, hi).select("user_id", slot_start("time", 60).cast("timestamp_ntz").alias("hour"), F.lit(s).alias("service"))
            for df, s in ((feed, "feed"), (msgs, "message"))]
    return (both[0].unionByName(both[1]).groupBy("service", "hour")
            .agg(F.hll_sketch_agg("user_id", log2k).alias("users"))
            .select("service", "hour", "users", F.to_date("hour").alias("event_date")))


def backfill_hourly_sketches(feed: DataFrame, msgs: DataFrame, name: str, lo, hi, log2k: int = SKETCH_LOG2) -> None:
    """Days lo..hi in one pass; each day replaces what stood there."""
    overwrite_partitions(hourly_sketches(feed, msgs, lo, hi, log2k), name)


def update_hourly_sketches(feed: DataFrame, msgs: DataFrame, name: str, d, log2k: int = SKETCH_LOG2) -> None:
    """Replace day d's sketches from that day's events."""
    replace_partition(hourly_sketches(feed, msgs, d, None, log2k).drop("event_date"), name, event_date=to_day(d))


def _between(sketches: DataFrame, lo, hi) -> DataFrame:
    return sketches.filter(F.col("event_date").between(F.lit(to_day(lo)), F.lit(to_day(hi))))


def merged_users(sketches: DataFrame, lo, hi, *by) -> DataFrame:
    """Estimated distinct users of the days lo..hi for each value of ``by`` (columns or names;
    none: one row), from stored sketches alone. Sketches of different size merge at the
    smaller one's precision."""
    estimate = F.hll_sketch_estimate(F.hll_union_agg("users", True)).alias("users")
    rows = _between(sketches, lo, hi)
    return rows.groupBy(*by).agg(estimate) if by else rows.agg(estimate)


def users_by_grain(sketches: DataFrame, lo, hi) -> DataFrame:
    """grain (hour, day, range), service ('all': any), start, users, over the days lo..hi:
    every level of the report from one read of the stored sketches."""
    starts = {"hour": F.col("hour"), "day": F.date_trunc("day", "hour").cast("timestamp_ntz"), "range": F.lit(to_day(lo)).cast("timestamp_ntz")}
    grains = F.array(*[F.named_struct(F.lit("grain"), F.lit(g), F.lit("start"), t) for g, t in starts.items()])
    rows = _between(sketches, lo, hi).select("users", F.explode(F.array(F.col("service"), F.lit("all"))).alias("service"), grains.alias("g"))
    rows = rows.select("users", "service", F.explode("g").alias("g"))
    return (rows.groupBy("g.grain", "service", "g.start").agg(F.hll_union_agg("users", True).alias("users"))
            .select("grain", "service", "start", F.hll_sketch_estimate("users").alias("users")))
