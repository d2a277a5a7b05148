"""Sinks: the daily cube table (S4, S5) and report rows.

Writes name the partition they replace (a day of the cube; a kind, day and slot of the
report rows): a rerun replaces exactly that partition, also with nothing, and leaves
every other one as it was.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.functions.columns import to_day, to_ts
from feedlens.sources.schema import CUBE_SCHEMA, REPORT_SCHEMA, conform

_DDL_TYPES = {"DateType()": "DATE", "StringType()": "STRING", "LongType()": "BIGINT",
              "TimestampNTZType()": "TIMESTAMP_NTZ"}


def _ddl(schema, partition_cols) -> str:
    cols = [f for f in schema.fields if f.name not in partition_cols]
    cols += [f for f in schema.fields if f.name in partition_cols]
    return ", ".join(f"`{f.name}` {_DDL_TYPES[repr(f.dataType)]}" for f in cols)


def ensure_table(spark: SparkSession, name: str, columns: str, partition_cols, location: str | None = None,
                 clustered: tuple[str, int] | None = None) -> None:
    """CREATE TABLE IF NOT EXISTS of Parquet files; ``clustered``: (column, buckets) by which
    every partition is bucketed and sorted. The table itself carries dynamic partition
    overwrite, for writes of many partitions (``overwrite_partitions``)."""
    loc = f" LOCATION '{location}'" if location else ""
    by = f" CLUSTERED BY ({clustered[0]}) SORTED BY ({clustered[0]}) INTO {clustered[1]} BUCKETS" if clustered else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet OPTIONS ('partitionOverwriteMode' 'dynamic') "
              f"PARTITIONED BY ({', '.join(partition_cols)}){by}{loc}")


def _ensure(spark: SparkSession, name: str, schema, partition_cols, location=None) -> None:
    ensure_table(spark, name, _ddl(schema, partition_cols), partition_cols, location)


def ensure_cube_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """CREATE TABLE IF NOT EXISTS, partitioned by event_date."""
    _ensure(spark, name, CUBE_SCHEMA, ["event_date"], location)


def overwrite_partitions(df: DataFrame, name: str) -> None:
    """Overwrite only the partitions present in ``df`` (tables made by ``_ensure``, which
    carry the dynamic mode). insertInto is positional: columns go in table order."""
    df.select(*df.sparkSession.table(name).columns).write.insertInto(name, overwrite=True)


def replace_partition(df: DataFrame, name: str, **values) -> None:
    """Replace the one partition that ``values`` name with ``df`` (without the partition
    columns); an empty ``df`` leaves it empty."""
    spark = df.sparkSession
    spec = ", ".join(f"`{k}` = " + (f"DATE '{v.isoformat()}'" if isinstance(v, dt.date) else f"'{v}'") for k, v in values.items())
    columns = ", ".join(f"`{c}`" for c in spark.table(name).columns if c not in values)
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({spec}) SELECT {columns} FROM {{rows}}", rows=df)


def write_cube(df: DataFrame, name: str, day) -> None:
    """Replace the cube's rows of ``day`` (S5); rows of other days are an error of the
    caller and are not written."""
    day = to_day(day)
    rows = conform(df, CUBE_SCHEMA, "cube").filter(F.col("event_date") == F.lit(day)).drop("event_date")
    replace_partition(rows, name, event_date=day)


def ensure_report_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """CREATE TABLE IF NOT EXISTS for report rows, partitioned by kind, day and slot."""
    _ensure(spark, name, REPORT_SCHEMA, ["kind", "report_date", "slot"], location)


def write_report(df: DataFrame, name: str, kind: str, day, run_ts, slot: str = "day") -> None:
    """Publish report rows (their ``text``) of one run, replacing earlier rows of the same
    (kind, day, slot) only (S6): alerts about other slots of the day stay."""
    rows = df.select(F.lit(to_ts(run_ts).isoformat(sep=" ")).cast("timestamp_ntz").alias("run_ts"), F.col("text"))
    replace_partition(rows, name, kind=kind, report_date=to_day(day), slot=slot)
