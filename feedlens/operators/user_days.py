"""Per-user day tables, bucketed by user, and the cube from them.

The day's per-user feed and message counters are kept as tables of their own, each day's
partition bucketed and sorted by user. Both tables are cut alike, so the join of a day's
feed users with its message users needs no shuffle on either side; the daily cube, other
cubes of the same day and later joins all use the same cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.functions.columns import to_day
from feedlens.operators import cube
from feedlens.operators.filters import between_dates
from feedlens.sources.sinks import ensure_table, overwrite_partitions

BUCKETS = 16   # at scale: enough that a bucket of a day fits a task (parameter ``buckets``)

_COLUMNS = {
    "feed": "user_id BIGINT, views BIGINT, likes BIGINT, os STRING, age_group STRING, gender_label STRING",
    "messages": "user_id BIGINT, messages_sent BIGINT, users_sent BIGINT, messages_received BIGINT, users_received BIGINT",
}


def ensure_user_days(spark: SparkSession, prefix: str, location: str | None = None, buckets: int = BUCKETS) -> None:
    """Tables ``{prefix}_feed`` and ``{prefix}_messages``, by event_date, in ``buckets`` by user."""
    for what, columns in _COLUMNS.items():
        place = f"{location}/{what}" if location else None
        ensure_table(spark, f"{prefix}_{what}", f"{columns}, event_date DATE", ["event_date"], place, ("user_id", buckets))


def write_user_days(feed: DataFrame, msgs: DataFrame, prefix: str, lo, hi=None, age_bins="fixed", buckets: int = BUCKETS) -> None:
    """Replace the partitions of the days lo..hi that have rows. One file a day and bucket."""
    hi = lo if hi is None else hi
    made = {"feed": cube.feed_users(between_dates(feed, lo, hi), age_bins), "messages": cube.message_users(between_dates(msgs, lo, hi))}
    for what, rows in made.items():
        overwrite_partitions(rows.repartition(buckets, "user_id"), f"{prefix}_{what}")


def merged_user_day(spark: SparkSession, prefix: str, d) -> DataFrame:
    """``cube.merged_by_user`` of day d with event_date, joined bucket by bucket."""
    day = F.lit(to_day(d))
    feed, msgs = (spark.table(f"{prefix}_{what}").filter(F.col("event_date") == day).drop("event_date") for what in ("feed", "messages"))
    return feed.hint("merge").join(msgs, "user_id").na.drop("any").withColumn("event_date", day)


def cube_from_user_days(spark: SparkSession, prefix: str, d, dedupe_messages: bool = False) -> DataFrame:
    """``cube.daily_cube`` of day d from the day tables."""
    return cube.cube_of(merged_user_day(spark, prefix, d), dedupe_messages)
