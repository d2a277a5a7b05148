"""Report rows (S6, K6, K15): one row per report with the numbers and a text.

The source jobs posted these texts to a chat; here they are DataFrame rows that
``write_report`` appends to a table, and a delivery service can pick up.
"""

from __future__ import annotations

import datetime as dt
import functools
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions.columns import to_day
from feedlens.operators import kpi

ONE_DAY = dt.timedelta(days=1)


def _pct(likes: str, views: str):
    """100 * likes / views rounded half-even to an integer, in exact integer math."""
    whole, rest = F.expr(f"(100 * {likes}) div {views}"), F.expr(f"(100 * {likes}) % {views}")
    up = (2 * rest > F.col(views)) | ((2 * rest == F.col(views)) & (whole % 2 == 1))
    return F.when(F.col(views) > 0, whole + up.cast("int"))


def _s(c) -> F.Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("n/a"))


def feed_report(feed: DataFrame, run_date) -> DataFrame:
    """Yesterday's views, likes, CTR and DAU as a report row (K6); one row even on
    a day without data."""
    y = to_day(run_date) - ONE_DAY
    t = kpi.feed_day_totals(feed, y).withColumn("ctr_pct", _pct("likes", "views"))
    text = F.concat(F.lit(f"Feed summary for {y.isoformat()}: views "), _s("views"),
                    F.lit(", likes "), _s("likes"), F.lit(", CTR "), _s("ctr_pct"),
                    F.lit("%, DAU "), _s("DAU"))
    return t.select(F.lit(y).alias("report_date"), F.lit("feed").alias("kind"), text.alias("text"))


@dataclass(frozen=True)
class FirstSeen:
    """Maintained first-seen tables (``operators.first_seen``): read by day instead of the
    whole event history."""
    users: DataFrame      # user_id, first_date
    sources: DataFrame    # user_id, source, first_date
    posts: DataFrame      # post_id, first_date


def app_numbers(feed: DataFrame, run_date, first_seen: FirstSeen | None = None) -> DataFrame:
    """One row: total, new_users, ads, organic, new_posts for yesterday."""
    y = to_day(run_date) - ONE_DAY
    names = ["total", "new_users", "ads", "organic", "new_posts"]
    if first_seen is None:
        parts = [kpi.active_users(feed, y), kpi.first_seen_counts(feed, y)]   # one history scan for the first-seen KPIs
    else:
        parts = [kpi.active_users(feed, y), kpi.new_users(feed, y, first_seen.users),
                 kpi.new_users_by_source(feed, y, first_seen.sources), kpi.new_posts(feed, y, first_seen.posts)]
    long = functools.reduce(DataFrame.unionByName, [
        p.select(F.explode(F.array(*[F.struct(F.lit(n).alias("m"), F.col(n).alias("v")) for n in p.columns])).alias("mv")).select("mv.m", "mv.v")
        for p in parts])
    return long.agg(*[F.max(F.when(F.col("m") == n, F.col("v"))).alias(n) for n in names])


def app_report(feed: DataFrame, run_date, first_seen: FirstSeen | None = None) -> DataFrame:
    """App summary for yesterday as a report row."""
    y = to_day(run_date) - ONE_DAY
    text = F.concat(F.lit(f"App summary for {y.isoformat()}: active users "), _s("total"),
                    F.lit(", new users "), _s("new_users"), F.lit(" (ads "), _s("ads"),
                    F.lit(", organic "), _s("organic"), F.lit("), new posts "), _s("new_posts"))
    return app_numbers(feed, run_date, first_seen).select(F.lit(y).alias("report_date"),
                                                          F.lit("app").alias("kind"), text.alias("text"))
