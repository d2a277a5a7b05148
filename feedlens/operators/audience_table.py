"""Weekly audience from a maintained table of week bits.

``audience.weekly_audience`` scans all history for every report. Here a user keeps one
64-bit row for each span of 62 weeks: bit k (1 to 62) says that the user was active in the
span's k-th week, bit 0 that it was in the week before the span. A row thus holds all that
its weeks' statuses need: with c = bits >> 1 (active in the week) and p = bits (active in
the week before), ``c & p`` are the retained weeks, ``c & ~p`` the new ones, ``p & ~c`` the
ones in which the user is gone. A report is one pass over rows of 16 bytes a user, without
a join and without shuffling users.

A day's events only set bits, so days may come late, out of order or twice. The table is
partitioned by span and hash part of the users; a day rewrites the parts of its own span
(and of the next, for a span's last week), never older ones.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.functions.columns import day_of, monday, to_day, week_start
from feedlens.operators.audience import signed_counts, widened
from feedlens.operators.filters import between_dates
from feedlens.session import checkpoint_dir
from feedlens.sources.sinks import ensure_table, overwrite_partitions

SPAN_WEEKS = 62
PARTS = 16
FIRST_MONDAY = dt.date(1970, 1, 5)


def ensure_audience_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Table (user_id, weeks; by span and part)."""
    ensure_table(spark, name, "user_id BIGINT, weeks BIGINT, span INT, part INT", ["span", "part"], location)


def _week_number(day: Column) -> Column:
    return F.floor(F.datediff(week_start(day), F.lit(FIRST_MONDAY)) / 7).cast("int")


def week_bits(feed: DataFrame, lo, hi) -> DataFrame:
    """user_id, weeks, span, part of the activity of days lo..hi."""
    week = _week_number(day_of("time"))
    span = F.floor(week / SPAN_WEEKS).cast("int")
    weeks = between_dates(feed, lo, hi).select("user_id", week.alias("week"), span.alias("span")).distinct()
    place = F.col("week") - F.col("span") * SPAN_WEEKS + 1
    here = F.struct("span", F.expr(f"shiftleft(1L, week - span * {SPAN_WEEKS} + 1)").alias("weeks"))
    after = F.struct((F.col("span") + 1).alias("span"), F.lit(1).cast("bigint").alias("weeks"))
    both = F.when(place == SPAN_WEEKS, F.array(here, after)).otherwise(F.array(here))
    return (weeks.select("user_id", F.explode(both).alias("b")).select("user_id", "b.*")
            .groupBy("user_id", "span").agg(F.bit_or("weeks").alias("weeks"))
            .select("user_id", "weeks", "span", F.pmod(F.xxhash64("user_id"), F.lit(PARTS)).cast("int").alias("part")))


def update_audience(feed: DataFrame, name: str, lo, hi=None) -> None:
    """Set the bits of day ``lo`` (or of the days lo..hi: the first load) in the table. Rerunning
    a day changes nothing."""
    spark, (lo, hi) = feed.sparkSession, (to_day(lo), to_day(lo if hi is None else hi))
    first, last = ((monday(d) - FIRST_MONDAY).days // 7 // SPAN_WEEKS for d in (lo, hi))
    new = week_bits(feed, lo, hi)
    touched = new.select("span", "part").distinct()    # at most the spans of the days times PARTS rows
    kept = (spark.table(name).filter(F.col("span").between(first, last + 1))
            .join(F.broadcast(touched), ["span", "part"], "left_semi").select(*new.columns))
    merged = (new.unionByName(kept).groupBy("user_id", "span", "part").agg(F.bit_or("weeks").alias("weeks"))
              .repartition("span", "part").select(*new.columns))
    checkpoint_dir(spark)
    overwrite_partitions(merged.checkpoint(), name)    # the input reads the table that is written


def user_week_statuses(table: DataFrame, run_date, since=None) -> DataFrame:
    """(week, status), one row per user and week with a status, as of ``run_date``'s week."""
    last = monday(to_day(run_date))
    first = None if since is None else monday(to_day(since))
    rows = table.filter(F.col("span") <= (last - FIRST_MONDAY).days // 7 // SPAN_WEEKS)
    if first is not None:
        rows = rows.filter(F.col("span") >= (first - FIRST_MONDAY).days // 7 // SPAN_WEEKS)
    now, before = F.shiftright("weeks", 1), F.col("weeks").bitwiseAND(F.lit((1 << SPAN_WEEKS) - 1))

    def weeks_of(bits: Column, status: str) -> Column:
        places = F.filter(F.sequence(F.lit(0), F.lit(SPAN_WEEKS - 1)), lambda k: F.getbit(bits, k) == 1)
        return F.transform(places, lambda k: F.struct(k.alias("k"), F.lit(status).alias("status")))

    found = F.concat(weeks_of(now.bitwiseAND(before), "retained"), weeks_of(now.bitwiseAND(F.bitwise_not(before)), "new"),
                     weeks_of(before.bitwiseAND(F.bitwise_not(now)), "gone"))
    week = F.date_add(F.lit(FIRST_MONDAY), (F.col("span") * SPAN_WEEKS + F.col("s.k")) * 7)
    out = rows.select("span", F.explode(found).alias("s")).select(week.alias("week"), "s.status").filter(F.col("week") <= F.lit(last))
    return out if first is None else out.filter(F.col("week") >= F.lit(first))


def weekly_audience(table: DataFrame, run_date, since=None) -> DataFrame:
    """``audience.weekly_audience`` from the maintained table, which holds the days up to
    ``run_date`` (K11)."""
    return signed_counts(user_week_statuses(table, run_date, since))


def weekly_audience_wide(table: DataFrame, run_date, since=None) -> DataFrame:
    """``audience.weekly_audience_wide`` from the maintained table."""
    return widened(weekly_audience(table, run_date, since))
