"""Late events: day tables and the cube kept right as files arrive.

New event files are read as a stream (``availableNow``: everything new, then stop). An
epoch's rows are written into day partitions of the event tables, whatever day they belong
to; the days that the epoch touched are found from the rows, and the cube is computed anew
for just these days, from their partitions, and replaces theirs in one commit. Events that
come days late thus correct the cube of their day, and partitions of other days keep their
files. A replayed epoch writes the same partitions again: nothing counts twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.operators import cube
from feedlens.sources.schema import CUBE_SCHEMA, FEED_SCHEMA, MESSAGE_SCHEMA, PARTITION_DATE, conform
from feedlens.sources.sinks import ensure_cube_table, overwrite_partitions

KINDS = {"feed": FEED_SCHEMA, "messages": MESSAGE_SCHEMA}


def _tagged(events: DataFrame, kind: str) -> DataFrame:
    """Rows of one table as (kind, event_date, row) with every other kind's row null."""
    rows = conform(events, KINDS[kind], kind).drop(PARTITION_DATE)
    rows = rows.withColumn("time", F.col("time").cast("timestamp_ntz"))
    own = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in KINDS[kind].fields])
    others = [F.lit(None).cast(schema).alias(k) for k, schema in KINDS.items() if k != kind]
    return rows.select(F.lit(kind).alias("kind"), F.to_date("time").alias(PARTITION_DATE), own.cast(KINDS[kind]).alias(kind), *others)


def event_table(spark: SparkSession, events_dir: str, kind: str) -> DataFrame:
    """The ingested rows of a kind, partitioned by day (and by the epoch that brought them)."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in KINDS[kind].fields)
    return spark.read.schema(f"{schema}, {PARTITION_DATE} date, epoch long").parquet(f"{events_dir.rstrip('/')}/{kind}")


def touched_days(batch: DataFrame) -> list:
    """The days that an epoch's rows belong to: one value a day comes to the driver."""
    return sorted(r[0] for r in batch.select(PARTITION_DATE).filter(f"{PARTITION_DATE} IS NOT NULL").distinct().collect())


def start_ingest_job(spark: SparkSession, feed: DataFrame, msgs: DataFrame, events_dir: str, cube_table: str, checkpoint: str,
                     cube_location: str | None = None, age_bins: str = "fixed", trigger: dict | None = None):
    """Start the job over two streams of events; returns the query. ``events_dir`` takes the
    day tables ``feed`` and ``messages``, ``cube_table`` (made if absent) the cube. Rows
    without a time belong to no day and are left out, as every day filter leaves them out."""
    ensure_cube_table(spark, cube_table, cube_location)
    events_dir = events_dir.rstrip("/")

    def handle(batch: DataFrame, epoch: int) -> None:
        rows = batch.filter(F.col(PARTITION_DATE).isNotNull()).persist()     # written by kind, and asked for its days
        try:
            days = touched_days(rows)
            for kind in KINDS:
                (rows.filter(F.col("kind") == kind).select(f"{kind}.*", PARTITION_DATE, F.lit(epoch).cast("long").alias("epoch"))
                 .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION_DATE, "epoch")
                 .parquet(f"{events_dir}/{kind}"))
        finally:
            rows.unpersist()
        if days:
            tables = (event_table(spark, events_dir, kind).drop("epoch") for kind in KINDS)
            overwrite_partitions(conform(cube.cube_days(*tables, days, age_bins), CUBE_SCHEMA, "cube"), cube_table)

    both = _tagged(feed, "feed").unionByName(_tagged(msgs, "messages"))
    writer = both.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(handle)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
