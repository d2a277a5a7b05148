"""Daily cube of feed and messenger counters by os / gender / age (K2-K4)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions.columns import age_group, day_of, gender_label, to_day
from feedlens.operators.filters import between_dates, on_day

ONE_DAY = dt.timedelta(days=1)
COUNTERS = ["views", "likes", "messages_sent", "users_sent", "messages_received", "users_received"]
DIMENSIONS = [("os", "os"), ("gender", "gender_label"), ("age", "age_group")]


def feed_users(rows: DataFrame, age_bins="fixed") -> DataFrame:
    """Per (day, user, os, gender label, age group) of feed rows: views, likes (K3).

    Grouping is by the derived labels, as in the source job; a user seen with two
    os values gets two rows.
    """
    return (rows.groupBy(day_of("time").alias("event_date"), "user_id", "os",
                         gender_label("gender").alias("gender_label"),
                         age_group("age", age_bins).alias("age_group"))
            .agg(F.count_if(F.col("action") == "view").alias("views"),
                 F.count_if(F.col("action") == "like").alias("likes"))
            .select("event_date", "user_id", "views", "likes", "os", "age_group", "gender_label"))


def feed_by_user(feed: DataFrame, d, age_bins="fixed") -> DataFrame:
    """``feed_users`` of day d."""
    return feed_users(on_day(feed, d), age_bins).drop("event_date")


def message_users(rows: DataFrame) -> DataFrame:
    """Per (day, sender) of message rows: messages and distinct receivers sent, and messages
    and distinct senders received (0 when none) (K4). Receive-only users are absent.

    One scan: every message becomes a 'sent' row for its sender and a 'received'
    row for its receiver. A first aggregate per (day, user, role, partner) -- shuffled
    on all of them, so a user with many partners is spread over many tasks -- gives
    the distinct partners; a second, per day and user, sums up (both partial map-side).
    Equivalent to aggregating senders and receivers separately and left-joining
    receivers onto senders, without the second scan and the join.
    """
    roles = rows.select(day_of("time").alias("event_date"), F.explode(F.array(
        F.struct(F.col("user_id").alias("u"), F.col("reciever_id").alias("partner"),
                 F.lit(True).alias("sent")),
        F.struct(F.col("reciever_id").alias("u"), F.col("user_id").alias("partner"),
                 F.lit(False).alias("sent")))).alias("r")).select("event_date", "r.*")
    # a NULL receiver receives nothing; a NULL sender still forms a sender group
    roles = roles.filter(F.col("sent") | F.col("u").isNotNull())
    per_partner = (roles.groupBy("event_date", "u", "sent", "partner")
                   .agg(F.count("partner").alias("n")))
    sent, recv = F.col("sent"), ~F.col("sent")
    has_partner = F.col("partner").isNotNull()
    per_user = per_partner.groupBy("event_date", "u").agg(
        F.max(sent.cast("int")).alias("is_sender"),
        F.coalesce(F.sum(F.when(sent, F.col("n"))), F.lit(0)).alias("messages_sent"),
        F.count_if(sent & has_partner).alias("users_sent"),
        F.coalesce(F.sum(F.when(recv, F.col("n"))), F.lit(0)).alias("messages_received"),
        F.count_if(recv & has_partner).alias("users_received"))
    return (per_user.filter(F.col("is_sender") == 1)
            .select("event_date", F.col("u").alias("user_id"), "messages_sent", "users_sent",
                    "messages_received", "users_received"))


def messages_by_user(msgs: DataFrame, d) -> DataFrame:
    """``message_users`` of day d."""
    return message_users(on_day(msgs, d)).drop("event_date")


def merged_by_user(feed: DataFrame, msgs: DataFrame, d, age_bins="fixed") -> DataFrame:
    """Users with feed activity and at least one sent message on day d.

    The source job's outer merge + dropna is an inner join of non-null rows; it is
    written as one (Catalyst would keep a full outer join otherwise).
    """
    return (feed_by_user(feed, d, age_bins)
            .join(messages_by_user(msgs, d), "user_id", "inner")
            .na.drop("any"))


def cube_of(merged: DataFrame, dedupe_messages: bool = False) -> DataFrame:
    """Counters summed by os, by gender and by age group for each day of ``merged`` rows
    (event_date and the columns of ``merged_by_user``).

    Default: one GROUPING SETS aggregate (one Expand, one shuffle). Message counters
    of a user with several feed rows repeat, as in the source job.
    ``dedupe_messages=True`` counts each user's message counters once per
    dimension value instead (two aggregates).
    """
    if not dedupe_messages:
        day = F.col("event_date")
        cube = (merged.groupingSets([[day, F.col("os")], [day, F.col("gender_label")], [day, F.col("age_group")]],
                                    "event_date", "os", "gender_label", "age_group")
                .agg(*[F.sum(c).alias(c) for c in COUNTERS],
                     F.grouping("os").alias("g_os"), F.grouping("gender_label").alias("g_gender")))
        dimension = (F.when(F.col("g_os") == 0, "os")
                     .when(F.col("g_gender") == 0, "gender").otherwise("age"))
        value = F.coalesce("os", "gender_label", "age_group")
    else:
        stacked = merged.select(
            "event_date", "user_id", *COUNTERS,
            F.explode(F.array(*[F.struct(F.lit(name).alias("dimension"), F.col(c).alias("value"))
                                for name, c in DIMENSIONS])).alias("dv"))
        per_user = (stacked.groupBy("event_date", "dv.dimension", "dv.value", "user_id")
                    .agg(F.sum("views").alias("views"), F.sum("likes").alias("likes"),
                         *[F.max(c).alias(c) for c in COUNTERS[2:]]))
        cube = per_user.groupBy("event_date", "dimension", "value").agg(*[F.sum(c).alias(c) for c in COUNTERS])
        dimension, value = F.col("dimension"), F.col("value")
    return cube.select("event_date", dimension.alias("dimension"),
                       value.alias("dimension_value"),
                       *[F.col(c).cast("bigint").alias(c) for c in COUNTERS])


def daily_cube(feed: DataFrame, msgs: DataFrame, run_date, age_bins="fixed",
               dedupe_messages: bool = False) -> DataFrame:
    """``cube_of`` yesterday (K2)."""
    y = to_day(run_date) - ONE_DAY
    merged = merged_by_user(feed, msgs, y, age_bins).withColumn("event_date", F.lit(y))
    return cube_of(merged, dedupe_messages)


def cube_days(feed: DataFrame, msgs: DataFrame, days, age_bins="fixed", dedupe_messages: bool = False) -> DataFrame:
    """``cube_of`` each of several days in one plan: both tables are read once, between the
    first and the last of the days."""
    days = sorted(map(to_day, days))

    def rows(df: DataFrame) -> DataFrame:
        return between_dates(df, days[0], days[-1]).filter(day_of("time").isin(days))

    merged = feed_users(rows(feed), age_bins).join(message_users(rows(msgs)), ["event_date", "user_id"]).na.drop("any")
    return cube_of(merged, dedupe_messages)
