"""Exact distinct users over any range of days from daily bitmaps (A3, K5, K7).

A distinct count can't be added up over days, so a 30-day count reads 30 days of events
each time it is asked. Here every user gets a dense number once, and a day is kept as
bitmaps of the numbers that were active: 32,768 users in 4 KB. OR-ing the bitmaps of a
range and counting their bits is exact, reads only the day partitions of the bitmap
table, and shuffles bitmaps, not users.

Numbers are dense within each of ``PARTS`` hash parts of the users, so handing out new ones
is a window over a part's new users of one day, never one over all users. A number, once
given, stays: bitmaps of different days and of late reruns fit together.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedlens.functions.columns import day_of, to_day
from feedlens.operators.filters import between_dates
from feedlens.session import checkpoint_dir
from feedlens.sources.sinks import ensure_table, overwrite_partitions, replace_partition

PARTS = 64
ONE_DAY = dt.timedelta(days=1)


def _part():
    return F.pmod(F.xxhash64("user_id"), F.lit(PARTS)).cast("int")


def ensure_user_bitmaps(spark: SparkSession, prefix: str, location: str | None = None) -> None:
    """Tables ``{prefix}_index`` (user_id, number; by part) and ``{prefix}_days`` (service,
    part, chunk, bits; by event_date)."""
    place = {t: f"{location}/{t}" if location else None for t in ("index", "days")}
    ensure_table(spark, f"{prefix}_index", "user_id BIGINT, number BIGINT, part INT", ["part"], place["index"])
    ensure_table(spark, f"{prefix}_days", "service STRING, part INT, chunk BIGINT, bits BINARY, event_date DATE", ["event_date"], place["days"])


def _active(feed: DataFrame, msgs: DataFrame, lo, hi) -> DataFrame:
    """Distinct (event_date, service, user_id) of a range of days; NULL users are no users."""
    both = [between_dates(df, lo, hi).select(day_of("time").alias("event_date"), F.lit(service).alias("service"), "user_id")
            for df, service in ((feed, "feed"), (msgs, "message"))]
    return both[0].unionByName(both[1]).filter(F.col("user_id").isNotNull()).distinct()


def _number_new_users(active: DataFrame, index: str) -> None:
    """Append the users that ``index`` doesn't hold, with the next numbers of their part.
    A rerun finds them there and adds nothing."""
    spark = active.sparkSession
    known = spark.table(index)
    new = active.select("user_id").distinct().withColumn("part", _part()).join(known, ["part", "user_id"], "left_anti")
    last = known.groupBy("part").agg(F.max("number").alias("last"))
    given = F.row_number().over(Window.partitionBy("part").orderBy("user_id")) + F.coalesce("last", F.lit(0))
    new = new.join(F.broadcast(last), "part", "left").select("user_id", given.cast("bigint").alias("number"), "part")   # one row a part
    checkpoint_dir(spark)
    new.checkpoint().write.insertInto(index)     # the input reads the table that is written


def _bitmaps(active: DataFrame, index: str) -> DataFrame:
    numbered = active.withColumn("part", _part()).join(active.sparkSession.table(index), ["part", "user_id"])
    return (numbered.groupBy("event_date", "service", "part", F.bitmap_bucket_number("number").alias("chunk"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")))


def backfill_user_bitmaps(feed: DataFrame, msgs: DataFrame, prefix: str, lo, hi) -> None:
    """Days lo..hi in one pass (the first load); each day's bitmaps replace what stood there."""
    active = _active(feed, msgs, lo, hi)
    _number_new_users(active, f"{prefix}_index")
    overwrite_partitions(_bitmaps(active, f"{prefix}_index"), f"{prefix}_days")


def update_user_bitmaps(feed: DataFrame, msgs: DataFrame, prefix: str, d) -> None:
    """Replace day d's bitmaps from that day's events; other days are not touched."""
    d = to_day(d)
    active = _active(feed, msgs, d, d)
    _number_new_users(active, f"{prefix}_index")
    replace_partition(_bitmaps(active, f"{prefix}_index").drop("event_date"), f"{prefix}_days", event_date=d)


def _chosen(days: DataFrame, services) -> DataFrame:
    return days if services is None else days.filter(F.col("service").isin(list(services)))


def distinct_users(days: DataFrame, lo, hi, services=None) -> DataFrame:
    """Exact distinct users active on any of the days lo..hi in any of ``services`` (None:
    all); one row. Reads the day partitions of the bitmap table only."""
    rows = _chosen(days, services).filter(F.col("event_date").between(F.lit(to_day(lo)), F.lit(to_day(hi))))
    merged = rows.groupBy("part", "chunk").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("users"))


def rolling_users(days: DataFrame, lo, hi, lengths=(1, 7, 14, 30), services=None) -> DataFrame:
    """Date, days, users: for each day of lo..hi with activity in the window, the exact
    distinct users of the ``days`` days that end with it. A bitmap goes to the windows it
    belongs to, so the shuffle holds at most sum(lengths) copies of a day's bitmaps."""
    lo, hi = to_day(lo), to_day(hi)
    rows = _chosen(days, services).filter(F.col("event_date").between(F.lit(lo - (max(lengths) - 1) * ONE_DAY), F.lit(hi)))

    def windows_of(n: int):
        ends = F.sequence(F.col("event_date"), F.date_add("event_date", n - 1))
        return F.transform(ends, lambda d: F.struct(d.alias("Date"), F.lit(n).alias("days")))

    windows = F.concat(*map(windows_of, lengths))
    spread = (rows.select("part", "chunk", "bits", F.explode(windows).alias("w")).select("part", "chunk", "bits", "w.*")
              .filter(F.col("Date").between(F.lit(lo), F.lit(hi))))
    merged = spread.groupBy("Date", "days", "part", "chunk").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy("Date", "days").agg(F.sum(F.bitmap_count("bits")).alias("users"))
