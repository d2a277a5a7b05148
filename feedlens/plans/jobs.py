"""The four scheduled jobs as callable plans (the scheduler itself is not built:
an external one calls these with the run date or the run time).

Each job composes operators into DataFrames and writes them through the
idempotent sinks, so a rerun for the same date replaces its own output.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.functions.columns import to_day
from feedlens.operators import anomaly, audience, audience_table, cube, distinct, first_seen, kpi, sketches
from feedlens.operators.experiment import daily
from feedlens.plans import reports
from feedlens.sources.sinks import ensure_cube_table, ensure_report_table, write_cube, write_report

ONE_DAY = dt.timedelta(days=1)


def daily_cube_job(spark: SparkSession, feed: DataFrame, msgs: DataFrame, run_date, table: str,
                   location: str | None = None, age_bins: str = "fixed") -> DataFrame:
    """Yesterday's cube into ``table`` (created if absent); returns the written rows."""
    ensure_cube_table(spark, table, location)
    out = cube.daily_cube(feed, msgs, run_date, age_bins)
    write_cube(out, table, to_day(run_date) - ONE_DAY)
    return spark.table(table).filter(F.col("event_date") == F.lit(to_day(run_date) - ONE_DAY))


@dataclass
class FeedReport:
    """Output of the feed report job."""
    summary: DataFrame      # one report row (report_date, kind, text)
    week: DataFrame         # chart table: Date, views, likes, CTR, DAU for the 7 days to run_date


def feed_report_job(spark: SparkSession, feed: DataFrame, run_date, table: str | None = None,
                    location: str | None = None) -> FeedReport:
    """Yesterday's feed summary row (written to ``table`` if given) and the 7-day chart table."""
    run_date = to_day(run_date)
    rep = FeedReport(reports.feed_report(feed, run_date),
                     kpi.feed_kpis(feed, run_date - dt.timedelta(days=6), run_date).orderBy("Date"))
    if table:
        ensure_report_table(spark, table, location)
        write_report(rep.summary, table, "feed", run_date - ONE_DAY, run_date)
    return rep


@dataclass
class AppReport:
    """Output of the app report job."""
    summary: DataFrame      # one report row
    activity: DataFrame     # chart: Date, avg_views, avg_likes (14 days to yesterday)
    audience: DataFrame     # chart: Date, gone, retained, new per week
    hourly: DataFrame       # chart: hour, users, service for yesterday


FIRST_SEEN_KEYS = {"users": {"user_id": "BIGINT"}, "sources": {"user_id": "BIGINT", "source": "STRING"}, "posts": {"post_id": "BIGINT"}}


def maintained_first_seen(spark: SparkSession, feed: DataFrame, day, prefix: str, location: str | None = None) -> reports.FirstSeen:
    """The first-seen tables ``{prefix}_users``, ``_sources`` and ``_posts`` with ``day`` in
    them. A missing table is made and filled from the history once; after that the update
    reads the feed of ``day`` only."""
    tables = {}
    for what, types in FIRST_SEEN_KEYS.items():
        name, new = f"{prefix}_{what}", not spark.catalog.tableExists(f"{prefix}_{what}")
        if new:
            first_seen.ensure_first_seen_table(spark, name, list(types), types, f"{location}/{what}" if location else None)
            first_seen.backfill_first_seen(feed, name, day)
        else:
            first_seen.update_first_seen(feed, name, day, list(types))
        tables[what] = spark.table(name)
    return reports.FirstSeen(**tables)


def maintained_audience(spark: SparkSession, feed: DataFrame, run_date, name: str, location: str | None = None) -> DataFrame:
    """The week-bits table with the days up to ``run_date`` in it. A missing table is made and
    filled from the history once; after that the update reads the feed of the run date and
    of the day before it (which was not over when its own run read it)."""
    run_date, new = to_day(run_date), not spark.catalog.tableExists(name)
    if new:
        audience_table.ensure_audience_table(spark, name, location)
        first = feed.agg(F.min(F.to_date("time"))).first()[0]
        if first is not None and first <= run_date:
            audience_table.update_audience(feed, name, first, run_date)
    else:
        audience_table.update_audience(feed, name, run_date - ONE_DAY, run_date)
    return spark.table(name)


def app_report_job(spark: SparkSession, feed: DataFrame, msgs: DataFrame, run_date,
                   table: str | None = None, location: str | None = None, first_seen_prefix: str | None = None,
                   first_seen_location: str | None = None, since=None, audience_name: str | None = None,
                   audience_location: str | None = None) -> AppReport:
    """Yesterday's app summary row (written to ``table`` if given) and the three chart tables.

    ``first_seen_prefix``: keep first-seen tables of that name and read the day's new users
    and posts from them; ``since``: first week of the audience chart; ``audience_name``: keep
    a week-bits table of that name and draw the chart, of any length, from it. With the first
    and one of the others, the report reads the days it is about, not the whole history."""
    run_date = to_day(run_date)
    seen = (maintained_first_seen(spark, feed, run_date - ONE_DAY, first_seen_prefix, first_seen_location)
            if first_seen_prefix else None)
    if audience_name:
        kept = maintained_audience(spark, feed, run_date, audience_name, audience_location)
        weeks = audience_table.weekly_audience_wide(kept, run_date, since)
    else:
        weeks = audience.weekly_audience_wide(feed, run_date, since=since)
    rep = AppReport(reports.app_report(feed, run_date, seen),
                    kpi.avg_activity(feed, run_date, 14).orderBy("Date"),
                    weeks,
                    kpi.hourly_users(feed, msgs, run_date - ONE_DAY))
    if table:
        ensure_report_table(spark, table, location)
        write_report(rep.summary, table, "app", run_date - ONE_DAY, run_date)
    return rep


@dataclass
class AlertRun:
    """Output of the anomaly alert job."""
    alerts: DataFrame       # newest slot per metric with is_alert, deviation, direction, text
    series: DataFrame       # chart: ts, metric, value, up, low (centred bounds)


def anomaly_alert_job(spark: SparkSession, feed: DataFrame, msgs: DataFrame, as_of,
                      table: str | None = None, location: str | None = None,
                      a: float = 2.0, n: int = 6) -> AlertRun:
    """Score the closed 15-minute slots up to as_of. When ``table`` is given, the metrics of
    the newest closed slot that alert (or have no value) become report rows of that slot
    (kind 'alert', run_ts = as_of): a rerun for the slot replaces them, alerts about other
    slots stay."""
    long = anomaly.unpivot_metrics(anomaly.slot_metrics(feed, msgs, as_of))
    run = AlertRun(anomaly.current_alerts(anomaly.iqr_bounds(long, a, n, "newest")),
                   anomaly.alert_series(anomaly.iqr_bounds(long, a, n, "centred")))
    if table:
        ensure_report_table(spark, table, location)
        slot = run.alerts.agg(F.max("ts")).first()[0]   # the newest closed slot with data
        if slot is not None:
            write_report(run.alerts.filter(F.col("text").isNotNull()), table, "alert", slot, as_of, slot.strftime("%H-%M"))
    return run


def user_counts_job(spark: SparkSession, feed: DataFrame, msgs: DataFrame, run_date, prefix: str, location: str | None = None) -> DataFrame:
    """Yesterday's bitmaps and hourly sketches into the tables ``{prefix}_index``, ``_days`` and
    ``_hours`` (made if absent); returns yesterday's exact users over 1, 7, 14 and 30 days."""
    day = to_day(run_date) - ONE_DAY
    distinct.ensure_user_bitmaps(spark, prefix, location)
    sketches.ensure_hourly_sketches(spark, f"{prefix}_hours", f"{location}/hours" if location else None)
    distinct.update_user_bitmaps(feed, msgs, prefix, day)
    sketches.update_hourly_sketches(feed, msgs, f"{prefix}_hours", day)
    return distinct.rolling_users(spark.table(f"{prefix}_days"), day, day)


def experiment_job(spark: SparkSession, feed: DataFrame, run_date, start, a, b, prefix: str, location: str | None = None,
                   control=None) -> DataFrame:
    """Yesterday's step of a running experiment that began on ``start``: its users' running sums
    and moments into ``{prefix}_users`` and ``{prefix}_moments`` (made if absent); returns
    Welch's statistics of each day so far. Reads yesterday's events only."""
    day = to_day(run_date) - ONE_DAY
    daily.ensure_experiment_tables(spark, prefix, location)
    daily.update_experiment(feed, prefix, (a, b), start, day)
    return daily.welch_running(spark.table(f"{prefix}_moments"), start, day, a, b, control)
