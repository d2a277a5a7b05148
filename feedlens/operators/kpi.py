"""Feed and app KPIs.

All are aggregates over a pushed-down time range; distinct counts use Spark's
distinct planning (partial aggregate on (key, user) first), which spreads a hot
key over many tasks before the final count.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions.columns import day_of, ratio, slot_start, to_day
from feedlens.operators.filters import between_dates, on_day, up_to_day

ONE_DAY = dt.timedelta(days=1)


SKETCH_LOG2 = 14   # 2**14 registers: a standard error of 0.8 %; up to about 1,500 users are counted one by one


def _distinct_users(c: str = "user_id", approx: bool = False):
    if not approx:
        return F.count_distinct(c)
    return F.hll_sketch_estimate(F.hll_sketch_agg(c, SKETCH_LOG2))


def feed_kpis(feed: DataFrame, lo, hi=None, approx: bool = False) -> DataFrame:
    """Per day in lo..hi: Date, views, likes, CTR, DAU (K5)."""
    hi = lo if hi is None else hi
    return (between_dates(feed, lo, hi)
            .groupBy(day_of("time").alias("Date"))
            .agg(F.count_if(F.col("action") == "view").alias("views"),
                 F.count_if(F.col("action") == "like").alias("likes"),
                 _distinct_users(approx=approx).alias("DAU"))
            .select("Date", "views", "likes", ratio("likes", "views").alias("CTR"), "DAU"))


def feed_day_totals(feed: DataFrame, d) -> DataFrame:
    """One row for day d even when it has no data (Q13): views, likes, CTR, DAU."""
    return (on_day(feed, d)
            .agg(F.count_if(F.col("action") == "view").alias("views"),
                 F.count_if(F.col("action") == "like").alias("likes"),
                 F.count_distinct("user_id").alias("DAU"))
            .select(F.lit(to_day(d)).alias("Date"), "views", "likes",
                    ratio("likes", "views").alias("CTR"), "DAU"))


def active_users(feed: DataFrame, d, approx: bool = False, population: str = "feed",
                 msgs: DataFrame | None = None) -> DataFrame:
    """Distinct users on day d; always one row (K7).

    population='feed' counts feed users (the source job left-joins messages but
    counts feed users only, Q8); 'either' counts users active in the feed or
    sending messages (needs ``msgs``).
    """
    users = on_day(feed, d).select("user_id")
    if population == "either":
        if msgs is None:
            raise ValueError("population='either' needs the message table")
        users = users.unionByName(on_day(msgs, d).select("user_id"))
    elif population != "feed":
        raise ValueError("population must be 'feed' or 'either'")
    return users.agg(_distinct_users(approx=approx).alias("total"))


def _first_seen(feed: DataFrame, d, keys: list[str]) -> DataFrame:
    """Keys whose first activity (over all history up to d) is on day d.

    The min() is a partial aggregate per task, so a hot key costs one row per task.
    """
    return (up_to_day(feed, d)
            .groupBy(*keys)
            .agg(F.min(day_of("time")).alias("start_date"))
            .filter(F.col("start_date") == F.lit(to_day(d))))


def _from_table(table: DataFrame, d) -> DataFrame:
    return table.filter(F.col("first_date") == F.lit(to_day(d)))


def new_users(feed: DataFrame, d, first_seen: DataFrame | None = None) -> DataFrame:
    """Users first seen on day d (K8); one row.

    ``first_seen``: a maintained first-seen table for user_id
    (``operators.first_seen``), read instead of the whole event history.
    """
    if first_seen is not None:
        return _from_table(first_seen, d).agg(F.count("user_id").alias("new_users"))
    return _first_seen(feed, d, ["user_id"]).agg(F.count("user_id").alias("new_users"))


def _arrivals(counted: F.Column, source: str) -> F.Column:
    return F.count_if(counted & (F.col("source") == source))


def new_users_by_source(feed: DataFrame, d, first_seen: DataFrame | None = None) -> DataFrame:
    """(user, source) pairs first seen on day d, split by source (K9); one row.

    A user arriving through both sources counts once per source, as in the source
    job; a NULL user is no user, here as in every KPI. ``first_seen``: a maintained table keyed by (user_id, source).
    """
    pairs = (_from_table(first_seen, d) if first_seen is not None
             else _first_seen(feed, d, ["user_id", "source"]))
    return (pairs
            .agg(*[_arrivals(F.col("user_id").isNotNull(), s).alias(s) for s in ("ads", "organic")]))


def new_posts(feed: DataFrame, d, first_seen: DataFrame | None = None) -> DataFrame:
    """Posts first seen on day d (K10); one row. ``first_seen``: a maintained table
    keyed by post_id."""
    posts = _from_table(first_seen, d) if first_seen is not None else _first_seen(feed, d, ["post_id"])
    return posts.agg(F.count("post_id").alias("new_posts"))


def avg_activity(feed: DataFrame, run_date, days: int = 14) -> DataFrame:
    """Mean views and likes per active user for each of the ``days`` days ending
    yesterday (K13). The day filter runs before the first aggregate."""
    y = to_day(run_date) - ONE_DAY
    per_user_day = (between_dates(feed, y - dt.timedelta(days=days - 1), y)
                    .groupBy("user_id", day_of("time").alias("Date"))
                    .agg(F.count_if(F.col("action") == "view").alias("views"),
                         F.count_if(F.col("action") == "like").alias("likes")))
    return (per_user_day.groupBy("Date")
            .agg(F.avg("views").alias("avg_views"), F.avg("likes").alias("avg_likes")))


def hourly_users(feed: DataFrame, msgs: DataFrame, d, approx: bool = False) -> DataFrame:
    """Distinct users per hour (its start) of day d in the feed and in the messenger.

    The two tables are unioned first and counted in one aggregate keyed by
    (service, hour), instead of two aggregates and a union of their results.
    """
    rows = (on_day(feed, d).select("user_id", "time", F.lit("feed").alias("service"))
            .unionByName(on_day(msgs, d).select("user_id", "time", F.lit("message").alias("service"))))
    return (rows.groupBy("service", slot_start("time", 60).cast("timestamp_ntz").alias("hour"))
            .agg(_distinct_users(approx=approx).alias("users"))
            .select("hour", "users", "service")
            .orderBy("service", "hour"))


def first_seen_counts(feed: DataFrame, d) -> DataFrame:
    """new_users, ads, organic, new_posts for day d from ONE scan of the history.

    One GROUPING SETS ((user_id, source), (user_id), (post_id)) aggregate gives the
    first day per (user, source), per user and per post (one Expand, one shuffle);
    a single global aggregate then counts the keys first seen on d, telling the
    sets apart by grouping_id. One row.
    """
    d = to_day(d)
    first = (up_to_day(feed, d)
             .groupingSets([[F.col("user_id"), F.col("source")], [F.col("user_id")], [F.col("post_id")]],
                           "user_id", "source", "post_id")
             .agg(F.min(day_of("time")).alias("start_date"), F.grouping_id().alias("gid")))
    # grouping_id bits (user_id, source, post_id): 1 = (user, source), 3 = (user), 6 = (post)
    on_d = F.col("start_date") == F.lit(d)
    pair = (F.col("gid") == 1) & F.col("user_id").isNotNull() & on_d
    return first.agg(
        F.count_if((F.col("gid") == 3) & F.col("user_id").isNotNull() & on_d).alias("new_users"),
        _arrivals(pair, "ads").alias("ads"), _arrivals(pair, "organic").alias("organic"),
        F.count_if((F.col("gid") == 6) & F.col("post_id").isNotNull() & on_d).alias("new_posts"))
