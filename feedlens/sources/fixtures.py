"""The two input tables as deterministic views over the driver's ``events`` table.

The view text is the test fixture's definition (fixed values, shared with the
DuckDB oracle in ``feedlens.plans.oracle``); only the day-number expression is
engine specific. Both views are narrow projections + filters over one scan, so
pruning and pushdown reach the parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedlens.sources.schema import FEED_SCHEMA, MESSAGE_SCHEMA, conform

# The fixture's view definitions, with {days} the engine's
# day-number expression.
FEED_VIEW_SQL = """
SELECT user_id, ts AS time,
       CASE WHEN event_type = 'click' THEN 'like' ELSE 'view' END AS action,
       CAST((user_id + CAST(floor(user_id / 10.0) AS BIGINT)) % 5 AS INT) AS exp_group,
       CAST(floor(event_id / 13.0) AS BIGINT) + event_id % 11 AS post_id,
       CASE WHEN (user_id + CASE WHEN event_id % 20 = 0 THEN 1 ELSE 0 END) % 3 = 0
            THEN 'iOS' ELSE 'Android' END AS os,
       CASE WHEN (user_id + CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0 END) % 4 = 0
            THEN 'ads' ELSE 'organic' END AS source,
       CAST(user_id % 2 AS INT) AS gender,
       CAST(15 + (user_id * 7) % 50 AS INT) AS age
FROM events
WHERE event_type IN ('view', 'signup', 'click')
  AND (user_id * 13 + CAST(floor({days} / 7.0) AS BIGINT) * 7) % 10 < 7
"""

MESSAGE_VIEW_SQL = """
SELECT user_id, user_id + 1 + event_id % 5 AS reciever_id, ts AS time
FROM events
WHERE event_type IN ('purchase', 'error')
"""

SPARK_DAYS = "datediff(CAST(ts AS DATE), DATE '2024-01-01')"
DUCKDB_DAYS = "date_diff('day', DATE '2024-01-01', CAST(ts AS DATE))"


def _view(spark: SparkSession, events: DataFrame, sql: str) -> DataFrame:
    # Bind `events` to this DataFrame only for this statement (no global view).
    return spark.sql(sql.replace("FROM events", "FROM {events}"), events=events)


def feed_from_events(spark: SparkSession, events: DataFrame) -> DataFrame:
    """The fixture's feed_actions view over ``events``."""
    df = _view(spark, events, FEED_VIEW_SQL.replace("{days}", SPARK_DAYS))
    return conform(df, FEED_SCHEMA, "feed_actions")


def messages_from_events(spark: SparkSession, events: DataFrame) -> DataFrame:
    """The fixture's message_actions view over ``events``."""
    return conform(_view(spark, events, MESSAGE_VIEW_SQL), MESSAGE_SCHEMA, "message_actions")


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's events table under ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def _alive(spark: SparkSession) -> bool:
    try:
        return spark.sparkContext._jsc is not None
    except Exception:  # Spark Connect sessions have no SparkContext
        return True


_FIXTURES: dict[tuple[int, str], tuple[SparkSession, DataFrame, DataFrame]] = {}


def load_fixture(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(feed_actions, message_actions) derived from ``{sf_dir}/events.parquet``.

    The two lazy DataFrames are kept per session and folder, so repeated queries
    skip the file listing, footer read and view analysis (the data is read by
    every query that runs; nothing is cached).
    """
    key = (id(spark), sf_dir.rstrip("/"))
    hit = _FIXTURES.get(key)
    # the entry holds the session itself, so its id cannot be reused while cached
    if hit is None or hit[0] is not spark or not _alive(spark):
        events = load_events(spark, sf_dir)
        hit = (spark, feed_from_events(spark, events), messages_from_events(spark, events))
        _FIXTURES[key] = hit
    return hit[1], hit[2]
