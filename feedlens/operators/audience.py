"""Weekly audience: new / retained / gone users per ISO week.

Instead of per-user week arrays (unbounded per user) or a self-join, every
(user, active week w) emits two flags: 1 = "active in w" and 2 = "active the week
before w + 7". One aggregate by (user, week) ORs the flags (partial aggregation
map-side, so a hot user costs one row per task), and the status follows:
3 -> retained, 1 -> new, 2 -> gone. A second, tiny aggregate counts per week.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions.columns import day_of, monday, to_day, week_start
from feedlens.operators.filters import between_dates, up_to_day

ACTIVE, ACTIVE_BEFORE = 1, 2


def user_week_status(feed: DataFrame, run_date, since=None) -> DataFrame:
    """(user_id, week, status) for every user/week with a status as of run_date.

    ``since``: first week to report (the week before it is read too, so its
    statuses are exact); None reads all history, as the source job does.
    """
    wk = week_start(day_of("time"))
    hist = up_to_day(feed, run_date)
    if since is not None:
        first = monday(to_day(since))
        hist = between_dates(hist, first - dt.timedelta(days=7), to_day(run_date))
    flags = hist.select(
        "user_id",
        F.explode(F.array(
            F.struct(wk.alias("week"), F.lit(ACTIVE).alias("flag")),
            F.struct(F.date_add(wk, 7).alias("week"), F.lit(ACTIVE_BEFORE).alias("flag")),
        )).alias("f"))
    per_user = flags.groupBy("user_id", F.col("f.week").alias("week")).agg(
        F.bit_or("f.flag").alias("flags"))
    status = (F.when(F.col("flags") == (ACTIVE | ACTIVE_BEFORE), "retained")
              .when(F.col("flags") == ACTIVE, "new").otherwise("gone"))
    out = per_user.select("user_id", "week", status.alias("status"))
    if since is not None:
        out = out.filter(F.col("week") >= F.lit(monday(to_day(since))))
    return out


def weekly_audience(feed: DataFrame, run_date, since=None) -> DataFrame:
    """Date (week Monday), status, num_users (double; gone is negative).

    'new' = active this week and not the week before (returning users included);
    'gone' rows for the week after run_date's week are dropped (not over yet).
    """
    next_week = monday(to_day(run_date)) + dt.timedelta(days=7)
    st = user_week_status(feed, run_date, since).filter(
        ~((F.col("status") == "gone") & (F.col("week") == F.lit(next_week))))
    return signed_counts(st)


def signed_counts(statuses: DataFrame) -> DataFrame:
    """Date, status, num_users from (week, status) rows, one per user."""
    counts = statuses.groupBy("week", "status").agg(F.count("*").alias("n"))
    sign = F.when(F.col("status") == "gone", F.lit(-1)).otherwise(F.lit(1))
    return (counts.select(F.col("week").alias("Date"), "status",
                          (F.col("n") * sign).cast("double").alias("num_users"))
            .orderBy(F.desc("num_users"), "Date", "status"))


def weekly_audience_wide(feed: DataFrame, run_date, since=None) -> DataFrame:
    """Date, gone, retained, new for weeks that have all three statuses."""
    return widened(weekly_audience(feed, run_date, since))


def widened(long: DataFrame) -> DataFrame:
    """One row per week of ``weekly_audience`` rows that has all three statuses."""
    wide = (long.groupBy("Date")
            .agg(*[F.max(F.when(F.col("status") == s, F.col("num_users"))).alias(s)
                   for s in ("gone", "retained", "new")]))
    return wide.na.drop("any").orderBy("Date")
