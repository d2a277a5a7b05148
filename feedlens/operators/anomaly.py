"""15-minute metrics and rolling interquartile anomaly bounds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlens.functions.columns import hm, ratio, slot_start
from feedlens.operators.filters import closed_slots, closed_slots_range

METRICS = ["users_feed", "views", "likes", "CTR", "users_mess", "sent_mess"]


def feed_slots(feed: DataFrame, minutes: int = 15) -> DataFrame:
    """Per slot: distinct feed users, views, likes."""
    return (feed.groupBy(slot_start("time", minutes).alias("ts"))
            .agg(F.count_distinct("user_id").alias("users_feed"),
                 F.count_if(F.col("action") == "view").alias("views"),
                 F.count_if(F.col("action") == "like").alias("likes")))


def message_slots(msgs: DataFrame, minutes: int = 15) -> DataFrame:
    """Per slot: distinct senders and messages sent."""
    return (msgs.groupBy(slot_start("time", minutes).alias("ts"))
            .agg(F.count_distinct("user_id").alias("users_mess"),
                 F.count("user_id").alias("sent_mess")))


def slot_events(feed: DataFrame, msgs: DataFrame) -> DataFrame:
    """Feed and message rows as one event stream: user_id, time, kind, is_msg. Rows are
    told apart by their source, so a feed action of any name counts as feed activity."""
    return (feed.select("user_id", "time", F.col("action").alias("kind"), F.lit(False).alias("is_msg"))
            .unionByName(msgs.select("user_id", "time", F.lit("msg").alias("kind"), F.lit(True).alias("is_msg"))))


def per_user_aggs():
    """First level (slot, user): feed rows, views, likes and messages sent."""
    feed = ~F.col("is_msg")
    return [F.count_if(feed).alias("acts"),
            F.count_if(feed & (F.col("kind") == "view")).alias("views"),
            F.count_if(feed & (F.col("kind") == "like")).alias("likes"),
            F.count_if("is_msg").alias("sent")]


def per_slot_aggs():
    """Second level (slot): the slot metrics plus row counts that say whether the
    slot has feed rows and message rows at all (a NULL user still makes a row but
    is not a user, and its messages are not counted as sent)."""
    known = F.col("user_id").isNotNull()
    return [F.count_if(known & (F.col("acts") > 0)).alias("users_feed"),
            F.sum("views").alias("views"), F.sum("likes").alias("likes"),
            F.count_if(known & (F.col("sent") > 0)).alias("users_mess"),
            F.coalesce(F.sum(F.when(known, F.col("sent"))), F.lit(0)).alias("sent_mess"),
            F.sum("acts").alias("feed_rows"),
            F.sum("sent").alias("msg_rows")]


def finish_slot_table(per_slot: DataFrame, ts) -> DataFrame:
    """Keep slots present in both tables; final column set."""
    return (per_slot.filter((F.col("feed_rows") > 0) & (F.col("msg_rows") > 0))
            .select(ts.alias("ts"), F.to_date(ts).alias("date"), hm(ts).alias("hm"),
                    "users_feed", "views", "likes", ratio("likes", "views").alias("CTR"),
                    "users_mess", "sent_mess"))


def finish_slots(feed_agg: DataFrame, msg_agg: DataFrame) -> DataFrame:
    """Inner join of the two per-slot aggregates (slots present in both)."""
    return (feed_agg.join(msg_agg, "ts", "inner")
            .select("ts", F.to_date("ts").alias("date"), hm("ts").alias("hm"),
                    "users_feed", "views", "likes", ratio("likes", "views").alias("CTR"),
                    "users_mess", "sent_mess"))


def slot_spine(spark, lo, hi, minutes: int = 15) -> DataFrame:
    """Every slot start in [lo, hi): at most one row per slot of the range."""
    step = F.expr(f"INTERVAL {minutes} MINUTES")
    last = hi - dt.timedelta(minutes=minutes)
    if last < lo:
        return spark.range(0).select(F.lit(None).cast("timestamp_ntz").alias("ts"))
    return spark.range(1).select(F.explode(F.sequence(
        F.lit(lo.isoformat(sep=" ")).cast("timestamp_ntz"),
        F.lit(last.isoformat(sep=" ")).cast("timestamp_ntz"), step)).alias("ts"))


def slot_metrics(feed: DataFrame, msgs: DataFrame, as_of, minutes: int = 15,
                 fill_gaps: bool = False) -> DataFrame:
    """Per closed slot from the start of yesterday to as_of's slot.

    Both sides are aggregated before the join; each side is a handful of rows per
    slot, so the join is tiny whatever the event volume. By default only slots
    present in both tables appear (so "n previous slots" means n previous rows,
    Q11); ``fill_gaps=True`` joins a slot spine instead and reports empty slots
    with zero counts (CTR NULL).
    """
    if not fill_gaps:
        # One aggregation chain for both tables (the same one the streaming job
        # uses): per (slot, user), then per slot -- two shuffles, no join. Equal
        # to the inner join of the two per-table slot aggregates.
        ev = slot_events(closed_slots(feed, as_of, minutes), closed_slots(msgs, as_of, minutes))
        per_user = ev.groupBy(slot_start("time", minutes).alias("ts"), "user_id").agg(*per_user_aggs())
        return finish_slot_table(per_user.groupBy("ts").agg(*per_slot_aggs()), F.col("ts"))
    f = feed_slots(closed_slots(feed, as_of, minutes), minutes)
    m = message_slots(closed_slots(msgs, as_of, minutes), minutes)
    lo, hi = closed_slots_range(as_of, minutes)
    spine = slot_spine(feed.sparkSession, lo, hi, minutes)
    zero = {c: 0 for c in ("users_feed", "views", "likes", "users_mess", "sent_mess")}
    full = spine.join(f, "ts", "left").join(m, "ts", "left").na.fill(zero)
    return finish_slots(full.select("ts", "users_feed", "views", "likes"),
                        full.select("ts", "users_mess", "sent_mess"))


def unpivot_metrics(slots: DataFrame, metrics=None, key: str = "ts") -> DataFrame:
    """Wide -> long (ts, metric, value double) over the metric list."""
    metrics = list(metrics or METRICS)
    casted = slots.select(key, *[F.col(m).cast("double").alias(m) for m in metrics])
    return casted.unpivot([key], metrics, "metric", "value")


def iqr_bounds(long_df: DataFrame, a: float = 2.0, n: int = 6, mode: str = "newest",
               key: str = "ts") -> DataFrame:
    """Rolling-IQR bounds per metric.

    q25/q75 over the n previous rows (NULL until n non-null values exist, W1/W2),
    up = q75 + a*iqr, low = q25 - a*iqr, then a rolling mean of the bounds:
    ``mode='centred'`` uses rows i-n//2 .. i+(n-1)//2 (looks ahead, as a chart),
    ``mode='newest'`` uses rows i-n//2 .. i (every slot scored as if newest, W4).
    is_alert: value < low or value > up, strictly; NULLs never alert.
    Windows are partitioned by metric (a few hundred slots each).
    """
    if mode not in ("newest", "centred"):
        raise ValueError("mode must be 'newest' or 'centred'")
    if n < 1:
        raise ValueError("n must be >= 1")
    order = Window.partitionBy("metric").orderBy(key)
    prev = order.rowsBetween(-n, -1)
    full = F.count("value").over(prev) == n
    q25 = F.when(full, F.percentile("value", 0.25).over(prev))
    q75 = F.when(full, F.percentile("value", 0.75).over(prev))
    raw = (long_df.withColumn("q25", q25).withColumn("q75", q75)
           .withColumn("iqr", F.col("q75") - F.col("q25"))
           .withColumn("up_raw", F.col("q75") + F.lit(a) * F.col("iqr"))
           .withColumn("low_raw", F.col("q25") - F.lit(a) * F.col("iqr")))
    hi = (n - 1) // 2 if mode == "centred" else 0
    smooth = order.rowsBetween(-(n // 2), hi)
    out = (raw.withColumn("up", F.avg("up_raw").over(smooth))
           .withColumn("low", F.avg("low_raw").over(smooth)))
    alert = F.coalesce((F.col("value") < F.col("low")) | (F.col("value") > F.col("up")),
                       F.lit(False))
    return out.select(key, "metric", "value", "q25", "q75", "iqr", "up", "low",
                      alert.alias("is_alert"))


def slot_alerts(scored: DataFrame, key: str = "ts") -> DataFrame:
    """Every slot of every metric with its previous value, deviation and direction
    (K18, W5, W6). ``scored`` comes from iqr_bounds(mode='newest').

    deviation_pct = |bround((1 - cur/prev) * 100, 2)|; direction is 'growth' when
    cur > prev, 'drop' when cur < prev (the source job's label was inverted).
    ``undefined`` marks a slot whose value does not exist (likes without views):
    it has no bounds to break, but it is not a quiet slot, so it gets a text too.
    """
    w = Window.partitionBy("metric").orderBy(key)
    rows = scored.withColumn("prev_value", F.lag("value", 1).over(w)).withColumn("undefined", F.col("value").isNull())
    dev = F.abs(F.bround((F.lit(1.0) - ratio("value", "prev_value")) * 100, 2))
    direction = (F.when(F.col("value") > F.col("prev_value"), "growth")
                 .when(F.col("value") < F.col("prev_value"), "drop").otherwise("flat"))

    def two_places(x):   # format_string would spell out a NULL
        return F.when(x.isNotNull(), F.format_string("%.2f", x)).otherwise("n/a")

    text = F.when(
        F.col("is_alert"),
        F.concat(F.lit("Anomaly ("), direction, F.lit(") in "), F.col("metric"),
                 F.lit(": current value "),
                 two_places(F.bround("value", 2)),
                 F.lit(", deviation from previous "),
                 two_places(dev), F.lit("%"))) \
        .when(F.col("undefined"), F.concat(F.lit("Undefined value of "), F.col("metric")))
    return rows.select(key, "metric", "value", "prev_value", "low", "up", "is_alert", "undefined",
                       dev.alias("deviation_pct"), direction.alias("direction"), text.alias("text"))


def current_alerts(scored: DataFrame, key: str = "ts") -> DataFrame:
    """The newest slot of every metric, as ``slot_alerts`` describes it."""
    rows = slot_alerts(scored, key)
    fields = [c for c in rows.columns if c != "metric"]
    return (rows.groupBy("metric").agg(F.max_by(F.struct(*fields), F.col(key)).alias("r"))
            .select(f"r.{key}", "metric", *[f"r.{c}" for c in fields if c != key]))


def alert_series(scored_centred: DataFrame, key: str = "ts") -> DataFrame:
    """Chart-ready series per metric: ts, metric, value, up, low."""
    return scored_centred.select(key, "metric", "value", "up", "low")
