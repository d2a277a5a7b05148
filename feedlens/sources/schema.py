"""Declared schemas of the two inputs and of every persisted output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# One row per feed action ('view' or 'like').
FEED_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("time", T.TimestampNTZType()),
    T.StructField("action", T.StringType()),
    T.StructField("exp_group", T.IntegerType()),
    T.StructField("post_id", T.LongType()),
    T.StructField("os", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("gender", T.IntegerType()),
    T.StructField("age", T.IntegerType()),
])

# One row per message; the receiver column keeps the source system's spelling.
MESSAGE_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("reciever_id", T.LongType()),
    T.StructField("time", T.TimestampNTZType()),
])

# Daily cube, partitioned by event_date.
CUBE_SCHEMA = T.StructType([
    T.StructField("event_date", T.DateType()),
    T.StructField("dimension", T.StringType()),
    T.StructField("dimension_value", T.StringType()),
    T.StructField("views", T.LongType()),
    T.StructField("likes", T.LongType()),
    T.StructField("messages_sent", T.LongType()),
    T.StructField("users_sent", T.LongType()),
    T.StructField("messages_received", T.LongType()),
    T.StructField("users_received", T.LongType()),
])

# Published report / alert rows (re-aimed from chat messages). ``slot`` is the 15-minute
# slot an alert is about ("HH-mm"), "day" for the daily reports; ``run_ts`` is the run
# time the scheduler passed. Rows are replaced by (kind, report_date, slot) only.
REPORT_SCHEMA = T.StructType([
    T.StructField("report_date", T.DateType()),
    T.StructField("kind", T.StringType()),
    T.StructField("slot", T.StringType()),
    T.StructField("run_ts", T.TimestampNTZType()),
    T.StructField("text", T.StringType()),
])

_TIME_TYPES = (T.TimestampNTZType, T.TimestampType)

# Optional date partition column of the event tables. When an input has it, it is
# kept through ``conform`` and every date filter also filters on it, so a table
# partitioned by day is pruned to the needed partitions before any file is opened.
PARTITION_DATE = "event_date"


def conform(df: DataFrame, schema: T.StructType, name: str = "input") -> DataFrame:
    """Select the schema's columns in order, casting where the type differs.

    Missing columns raise. A timestamp column may be either NTZ or LTZ (streams use
    LTZ because watermarks require it), so time columns are left as they are.
    This is a plain projection, so pruning and filter pushdown are unaffected.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in have]
    if missing:
        raise ValueError(f"{name}: missing columns {missing}; has {sorted(have)}")
    cols = []
    for f in schema.fields:
        dt = have[f.name]
        if isinstance(f.dataType, _TIME_TYPES) and isinstance(dt, _TIME_TYPES):
            cols.append(F.col(f.name))
        elif dt == f.dataType:
            cols.append(F.col(f.name))
        else:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
    if PARTITION_DATE in have and PARTITION_DATE not in schema.fieldNames():
        cols.append(F.col(PARTITION_DATE).cast("date").alias(PARTITION_DATE))
    return df.select(*cols)
