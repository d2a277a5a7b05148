"""Streaming 15-minute metrics and alerts.

The streaming form of ``anomaly.slot_metrics`` uses the same aggregation chain as
the batch one: feed and message events are unioned with a ``kind`` column,
watermarked, and aggregated twice -- per (slot, user), then per slot; a slot is
kept when it has both feed rows and message rows. No stream-stream join (and no
join state) is needed, and exact distinct users per slot come from the first
aggregate (one row per user and slot), which exact ``count_distinct`` cannot do
on a stream.

Each source is watermarked on its own before the union, and the query's watermark is
the smaller of the two: a slot waits for the slower source (after a restart, until
both have new rows). Append mode releases a
slot once that watermark passes its end, so every emitted slot is final.
Closed slots then go, one row per metric, through a keyed state that holds the
n + n//2 newest (slot, value) pairs of each metric, all that the next slot's bound
depends on. It gives back the new slots with those before them, so ``foreachBatch``
scores every slot of an epoch, however many one epoch closes, with the batch IQR
operator, and reads nothing of what earlier epochs wrote: an epoch costs the same in
the first week and after years. It writes ``date=/batch_id=`` partitions with dynamic
overwrite, so a replayed epoch (after a failure) replaces its own output instead of
duplicating it; the state of an epoch is part of the checkpoint.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from feedlens.operators import anomaly

# The state processor is shipped by value: Python workers don't need this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def slot_stream(feed: DataFrame, msgs: DataFrame, minutes: int = 15,
                delay: str = "15 minutes", approx: bool = False) -> DataFrame:
    """Per closed slot: ts, date, hm, users_feed, views, likes, CTR, users_mess, sent_mess.

    ``delay`` is the lateness allowance: events up to ``delay`` behind the newest
    event time still count; a slot is final (and emitted) once the newest event
    time passes its end + delay.

    ``approx=True`` counts distinct users with HyperLogLog sketches in a single
    stateful aggregation per slot: state per open slot is a fixed-size sketch
    instead of one row per active user (for very large audiences).
    """
    def marked(events: DataFrame) -> DataFrame:
        return events.withColumn("time", F.col("time").cast("timestamp")).withWatermark("time", delay)

    ev = anomaly.slot_events(marked(feed), marked(msgs))
    width = f"{minutes} minutes"
    if approx:
        known, is_msg = F.col("user_id").isNotNull(), F.col("is_msg")
        is_feed, kind = ~is_msg, F.when(~is_msg, F.col("kind"))
        per_slot = ev.groupBy(F.window("time", width).alias("slot")).agg(
            F.approx_count_distinct(F.when(is_feed, F.col("user_id"))).alias("users_feed"),
            F.count_if(kind == "view").alias("views"), F.count_if(kind == "like").alias("likes"),
            F.approx_count_distinct(F.when(is_msg, F.col("user_id"))).alias("users_mess"),
            F.count_if(is_msg & known).alias("sent_mess"),
            F.count_if(is_feed).alias("feed_rows"), F.count_if(is_msg).alias("msg_rows"))
        return anomaly.finish_slot_table(per_slot, F.col("slot.start").cast("timestamp_ntz"))
    per_user = ev.groupBy(F.window("time", width).alias("w"), "user_id").agg(*anomaly.per_user_aggs())
    per_slot = (per_user.groupBy(F.window(F.window_time("w"), width).alias("slot"))
                .agg(*anomaly.per_slot_aggs()))
    return anomaly.finish_slot_table(per_slot, F.col("slot.start").cast("timestamp_ntz"))


def slots_before(n: int = 6) -> int:
    """Slots before one that its bound depends on: n for the quantiles + n//2 for smoothing."""
    return n + n // 2


def score_slots(slots: DataFrame, before: DataFrame, n: int = 6, a: float = 2.0) -> DataFrame:
    """``anomaly.slot_alerts`` rows of all ``slots``; ``before``: the slots preceding them,
    of which the last n + n//2 are used (a top-k that the bounds are defined by)."""
    last = before.orderBy(F.desc("ts")).limit(slots_before(n)).select(*slots.columns)
    rows = anomaly.unpivot_metrics(last.unionByName(slots))
    scored = anomaly.slot_alerts(anomaly.iqr_bounds(rows, a, n, "newest"))
    return scored.filter(F.col("ts") >= slots.agg(F.min("ts")).scalar())


class MetricHistory(StatefulProcessor):
    """Keyed by metric: every new (slot, value) row, and before them the rows of the state,
    the ``keep`` newest of earlier epochs. Slots arrive once and in the order of epochs."""

    def __init__(self, keep: int):
        self.keep = keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getListState("last", "ts string, value double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(rows).sort_values("ts")[["ts", "value"]]
        before = pd.DataFrame(list(self.last.get()), columns=["ts", "value"]).astype({"value": "float64"})
        out = pd.concat([before.assign(is_new=False), new.assign(is_new=True)])
        kept = out.tail(self.keep)
        self.last.put([(t, None if pd.isna(v) else float(v)) for t, v in zip(kept["ts"], kept["value"])])
        yield out.assign(metric=key[0])[["ts", "metric", "value", "is_new"]]

    def close(self) -> None:
        pass


def with_history(slots: DataFrame, n: int = 6) -> DataFrame:
    """The metrics of a stream of closed slots (ts, metric, value, is_new): each epoch's new
    rows with the n + n//2 before them. ``ts`` is text of a fixed form, which sorts alike."""
    rows = anomaly.unpivot_metrics(slots).withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return rows.groupBy("metric").transformWithStateInPandas(
        MetricHistory(slots_before(n)), "ts string, metric string, value double, is_new boolean", "Append", "None")


def score_epoch(rows: DataFrame, n: int = 6, a: float = 2.0) -> DataFrame:
    """``anomaly.slot_alerts`` rows of an epoch's new slots from ``with_history`` rows."""
    rows = rows.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    scored = anomaly.slot_alerts(anomaly.iqr_bounds(rows, a, n, "newest"))
    return scored.filter(F.col("ts") >= rows.filter("is_new").agg(F.min("ts")).scalar())


def slots_of(rows: DataFrame) -> DataFrame:
    """The new slots of ``with_history`` rows as one row each."""
    def value(metric: str, kind: str):
        return F.max(F.when(F.col("metric") == metric, F.col("value"))).cast(kind).alias(metric)

    ts = F.col("ts").cast("timestamp_ntz")
    wide = rows.filter("is_new").groupBy(ts.alias("ts")).agg(
        *[value(m, "double" if m == "CTR" else "long") for m in anomaly.METRICS])
    return wide.select("ts", F.date_format("ts", "HH:mm").alias("hm"), *anomaly.METRICS, F.to_date("ts").alias("date"))


def start_slot_job(spark: SparkSession, feed: DataFrame, msgs: DataFrame, out_dir: str,
                   checkpoint: str, trigger: dict | None = None,
                   minutes: int = 15, delay: str = "15 minutes", approx: bool = False,
                   n: int = 6, a: float = 2.0):
    """Start the streaming job; closed slots go to ``{out_dir}/slots``, the scored rows of
    every closed slot to ``{out_dir}/alerts``. ``checkpoint`` is the job's memory of what
    it has read and of the slots that the next bounds depend on: the same folder at every
    start, in storage that all executors share. The job keeps its state in RocksDB."""
    slots_dir, alerts_dir = f"{out_dir.rstrip('/')}/slots", f"{out_dir.rstrip('/')}/alerts"

    def handle(batch: DataFrame, epoch: int) -> None:
        rows = batch.persist()     # two outputs of one run of the stateful plan
        try:
            if rows.isEmpty():
                return
            (slots_of(rows).withColumn("batch_id", F.lit(epoch).cast("long")).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("date", "batch_id")
             .parquet(slots_dir))
            (score_epoch(rows, n, a).withColumn("epoch", F.lit(epoch))
             .write.mode("overwrite").parquet(f"{alerts_dir}/batch_id={epoch}"))
        finally:
            rows.unpersist()

    writer = (with_history(slot_stream(feed, msgs, minutes, delay, approx), n).writeStream.outputMode("append")
              .option("checkpointLocation", checkpoint).foreachBatch(handle))
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_PROVIDER)   # taken over by the query at its start
    try:
        return writer.start()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture's events table as a file stream (one file -> one micro-batch)."""
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
            .parquet(sf_dir.rstrip("/")))
