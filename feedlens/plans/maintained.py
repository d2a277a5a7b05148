"""Catalog queries over maintained tables: each fills its tables from the fixture, brings
them up to date day by day with the library's own updates, and reads the result from them."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from feedlens.operators import audience_table, distinct, filters, first_seen, kpi, seen_filter, sketches, user_days
from feedlens.operators import experiment as ex
from feedlens.operators.experiment import daily, sketched
from feedlens.plans import catalog as c
from feedlens.plans.catalog import query
from feedlens.sources.fixtures import feed_from_events, load_events, messages_from_events
from feedlens.streaming import start_ingest_job

# The fixture's days and the days that are added one by one.
FIRST_DAY, LAST_DAY = dt.date(2024, 1, 1), dt.date(2024, 1, 31)
UPDATES = [LAST_DAY - dt.timedelta(days=1), LAST_DAY]
WINDOWS = (7, 14, 30)
EXACT_PAIRS = [(1, 2), (0, 3), (0, 4)]
QUANTILE = 0.9
LATE_DAYS = (dt.date(2024, 1, 7), dt.date(2024, 1, 8))


def _backfilled() -> dt.date:
    return UPDATES[0] - dt.timedelta(days=1)


@query("rolling_users")
def _rolling_users(feed, msgs, sf):
    """A3: exact distinct users of the 7, 14 and 30 days up to each day, in the feed or the
    messenger, from daily bitmaps."""
    spark = feed.sparkSession
    prefix, path = c._scratch(spark, "bitmaps")
    distinct.ensure_user_bitmaps(spark, prefix, path)
    distinct.backfill_user_bitmaps(feed, msgs, prefix, FIRST_DAY, _backfilled())
    for d in UPDATES:
        distinct.update_user_bitmaps(feed, msgs, prefix, d)
    return distinct.rolling_users(spark.table(f"{prefix}_days"), FIRST_DAY, LAST_DAY, WINDOWS)


@query("feed_kpis_approx")
def _feed_kpis_approx(feed, msgs, sf):
    """A4: the week's KPIs with sketched DAU. A day of the fixture has few enough users for
    the sketch to count them one by one, so the exact count is the right answer."""
    return kpi.feed_kpis(feed, c.RUN_DATE - dt.timedelta(days=6), c.RUN_DATE, approx=True)


@query("hourly_users_approx")
def _hourly_users_approx(feed, msgs, sf):
    """Sketched users of each hour."""
    return kpi.hourly_users(feed, msgs, c.YESTERDAY, approx=True)


@query("users_by_grain")
def _users_by_grain(feed, msgs, sf):
    """Users by hour, by day and of the week, per service and of both, merged from
    stored hourly sketches."""
    spark = feed.sparkSession
    name, path = c._scratch(spark, "sketches")
    sketches.ensure_hourly_sketches(spark, name, path)
    lo = c.RUN_DATE - dt.timedelta(days=6)
    sketches.backfill_hourly_sketches(feed, msgs, name, lo - dt.timedelta(days=1), c.YESTERDAY)
    sketches.update_hourly_sketches(feed, msgs, name, c.RUN_DATE)
    return sketches.users_by_grain(spark.table(name), lo, c.RUN_DATE)


def _audience_table(feed):
    """All days up to the run date, the last ones out of order and one of them twice."""
    spark = feed.sparkSession
    name, path = c._scratch(spark, "audience")
    audience_table.ensure_audience_table(spark, name, path)
    late = [c.WEEKLY_RUN_DATE, dt.date(2024, 1, 22), c.WEEKLY_RUN_DATE]
    before = filters.up_to_day(feed, c.WEEKLY_RUN_DATE).filter(~F.to_date("time").isin(late))
    audience_table.update_audience(before, name, FIRST_DAY, c.WEEKLY_RUN_DATE)
    for d in late:
        audience_table.update_audience(feed, name, d)
    return spark.table(name)


@query("weekly_audience_maintained")
def _weekly_audience_maintained(feed, msgs, sf):
    """K11 from the table of week bits."""
    return audience_table.weekly_audience(_audience_table(feed), c.WEEKLY_RUN_DATE)


@query("weekly_audience_wide_maintained")
def _weekly_audience_wide_maintained(feed, msgs, sf):
    """K12 from the table of week bits, since a given week."""
    return audience_table.weekly_audience_wide(_audience_table(feed), c.WEEKLY_RUN_DATE, since="2024-01-10")


@query("mann_whitney_exact")
def _mann_whitney_exact(feed, msgs, sf):
    """T2 on the groups' CTR by day: seven values each, so the exact distribution of U."""
    days = (filters.between_dates(feed, c.AB_LO, c.AB_HI).groupBy("exp_group", F.to_date("time").alias("day"))
            .agg((F.count_if(F.col("action") == "like") / F.nullif(F.count_if(F.col("action") == "view"), F.lit(0))).alias("ctr")))
    parts = [ex.mann_whitney(days, "ctr", a, b).select(F.lit(a).alias("a"), F.lit(b).alias("b"), "n_a", "n_b", "u_a", "u_b", "p_value", "method")
             for a, b in EXACT_PAIRS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("bucket_metrics_xxh64")
def _bucket_metrics_xxh64(feed, msgs, sf):
    """T5 with the bucket ids of xxHash64(user_id) % 50 over 64-bit ids, seed 0."""
    return ex.bucket_metrics(feed, (c.AB_A, c.AB_B), c.AB_LO, c.AB_HI, c.N_BUCKETS, 0.9, "xxh64")


@query("user_buckets_xxh64")
def _user_buckets_xxh64(feed, msgs, sf):
    """every user's bucket over 32-bit ids."""
    users = feed.select("user_id").distinct()
    return ex.with_bucket(users, c.N_BUCKETS, "xxh64_32")


@query("cube_late_events")
def _cube_late_events(feed, msgs, sf):
    """Events in two arrivals, the second with some of two earlier days; the cube of
    all days as the ingestion leaves it."""
    spark = feed.sparkSession
    name, path = c._scratch(spark, "late")
    events = load_events(spark, sf)
    late = F.to_date("ts").isin(list(LATE_DAYS)) & (F.col("event_id") % 3 == 0)
    arrivals = os.path.join(path, "arrivals")
    for rows in (events.filter(~late), events.filter(late)):
        rows.write.mode("append").parquet(arrivals)
        stream = spark.readStream.schema(events.schema).parquet(arrivals)
        q = start_ingest_job(spark, feed_from_events(spark, stream), messages_from_events(spark, stream), os.path.join(path, "events"),
                             name, os.path.join(path, "checkpoint"), os.path.join(path, "cube"), "reference")
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return spark.table(name)


@query("daily_cube_bucketed")
def _daily_cube_bucketed(feed, msgs, sf):
    """K2 from per-user day tables bucketed by user, joined without a shuffle."""
    spark = feed.sparkSession
    prefix, path = c._scratch(spark, "user_days")
    user_days.ensure_user_days(spark, prefix, path)
    user_days.write_user_days(feed, msgs, prefix, c.YESTERDAY - dt.timedelta(days=1), c.YESTERDAY, "reference")
    return user_days.cube_from_user_days(spark, prefix, c.YESTERDAY)


@query("welch_running")
def _welch_running(feed, msgs, sf):
    """Welch on raw CTR and linearized likes after each day of the experiment, from
    moments updated by one day of events at a time."""
    spark = feed.sparkSession
    prefix, path = c._scratch(spark, "running")
    daily.ensure_experiment_tables(spark, prefix, path)
    for k in range((c.AB_HI - c.AB_LO).days + 1):
        daily.update_experiment(feed, prefix, (c.AB_A, c.AB_B), c.AB_LO, c.AB_LO + dt.timedelta(days=k))
    return daily.welch_running(spark.table(f"{prefix}_moments"), c.AB_LO, c.AB_HI, c.AB_A, c.AB_B)


@query("sketched_quantiles")
def _sketched_quantiles(feed, msgs, sf):
    """The 0.9-quantile of the time of day (in seconds) of the week's actions by group and
    os, bracketed by stored daily sketches."""
    spark = feed.sparkSession
    _, path = c._scratch(spark, "sketched")
    seconds = F.hour("time") * 3600 + F.minute("time") * 60 + F.second("time")
    rows = filters.last_days(feed, c.AB_HI, 7).select("exp_group", "os", F.to_date("time").alias("event_date"), seconds.alias("seconds"))
    keys = ["exp_group", "os"]
    sketched.value_sketches(rows, [*keys, "event_date"], "seconds").write.partitionBy("event_date").parquet(path)
    merged = sketched.merged_sketches(spark.read.parquet(path), keys)
    return sketched.sketched_quantile(rows, keys, "seconds", QUANTILE, sketches=merged)


@query("new_users_filtered")
def _new_users_filtered(feed, msgs, sf):
    """K8: new users by day, the last days looked up through a Bloom filter."""
    spark = feed.sparkSession
    name, path = c._scratch(spark, "seen")
    first_seen.ensure_first_seen_table(spark, name, ["user_id"], {"user_id": "BIGINT"}, os.path.join(path, "table"))
    seen_filter.ensure_filter_table(spark, f"{name}_filter", os.path.join(path, "filter"))
    start = c.YESTERDAY - dt.timedelta(days=3)
    seen_filter.backfill(feed, name, f"{name}_filter", start)
    for k in range(3):
        d = start + dt.timedelta(days=k + 1)
        seen_filter.update(feed, name, f"{name}_filter", d, d - dt.timedelta(days=1))
    return spark.table(name).groupBy("first_date").agg(F.count("*").alias("n_new"))
