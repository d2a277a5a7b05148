"""Scans of the feed and message tables (catalog table or files)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from feedlens.sources.schema import FEED_SCHEMA, MESSAGE_SCHEMA, conform


@dataclass(frozen=True)
class TableRef:
    """Where a table lives: a catalog name, or a path with a format and options."""

    name: str | None = None
    path: str | None = None
    format: str = "parquet"
    options: dict = field(default_factory=dict)

    def load(self, spark: SparkSession) -> DataFrame:
        if self.name:
            return spark.table(self.name)
        if not self.path:
            raise ValueError("TableRef needs a name or a path")
        return spark.read.format(self.format).options(**self.options).load(self.path)


def _as_ref(source) -> TableRef:
    if isinstance(source, TableRef):
        return source
    if isinstance(source, str):
        return TableRef(path=source) if "/" in source else TableRef(name=source)
    raise TypeError(f"unsupported source {source!r}")


def read_feed(spark: SparkSession, source) -> DataFrame:
    """Feed actions checked against FEED_SCHEMA."""
    return conform(_as_ref(source).load(spark), FEED_SCHEMA, "feed_actions")


def read_messages(spark: SparkSession, source) -> DataFrame:
    """Message actions checked against MESSAGE_SCHEMA."""
    return conform(_as_ref(source).load(spark), MESSAGE_SCHEMA, "message_actions")
