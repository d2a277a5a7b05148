"""Bloom filters before the first-seen lookup.

``first_seen`` joins each day's keys with every key ever seen. A Bloom filter of the seen
keys, 12 bits each, decides most of them: a key with a bit missing is new without any
lookup, and only keys that the filter may hold are joined with the table. The filter's
bits are rows of 32,768 (``bitmap_construct_agg``), so it is spread over the cluster like
any table, is never broadcast, and a day's new keys are OR-ed into it.

A day's filter is a partition of its own, made from the day before and the day's new
keys, so a day that runs again replaces its own and a failed run leaves none behind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.functions.columns import to_day
from feedlens.operators import first_seen
from feedlens.operators.filters import on_day
from feedlens.session import checkpoint_dir
from feedlens.sources.sinks import ensure_table, overwrite_partitions, replace_partition

HASHES = 4
BITS_A_KEY = 12          # with 4 hashes: about 0.6 % of new keys are looked up for nothing
CAPACITY = 1 << 20       # keys that the filter is made for; beyond it more keys are looked up, none is lost


def ensure_filter_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Table (chunk, bits; by as_of)."""
    ensure_table(spark, name, "chunk BIGINT, bits BINARY, as_of DATE", ["as_of"], location)


def _places(keys: list[str], capacity: int) -> Column:
    """The filter's bit numbers of a key, from 1."""
    m = F.lit(capacity * BITS_A_KEY)
    return F.array(*[F.pmod(F.xxhash64(F.lit(k), *keys), m) + 1 for k in range(HASHES)])


def key_bits(rows: DataFrame, keys: list[str], capacity: int = CAPACITY) -> DataFrame:
    """chunk, bits of the filter that holds the keys of ``rows``."""
    places = rows.select(F.explode(_places(keys, capacity)).alias("p"))
    return (places.groupBy(F.bitmap_bucket_number("p").alias("chunk"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")))


def maybe_seen(rows: DataFrame, bits: DataFrame, keys: list[str], capacity: int = CAPACITY) -> DataFrame:
    """The distinct keys of ``rows`` all of whose bits are set in ``bits``."""
    asked = rows.select(*keys).distinct().select(*keys, F.explode(_places(keys, capacity)).alias("__p"))
    asked = asked.select(*keys, F.bitmap_bucket_number("__p").alias("chunk"), F.bitmap_bit_position("__p").alias("__bit"))
    byte = F.conv(F.hex(F.substr("bits", (F.floor(F.col("__bit") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("bigint")
    is_set = F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod("__bit", F.lit(8)))), F.lit(2)) == 1
    held = asked.join(bits.select("chunk", "bits"), "chunk", "left").select(*keys, F.coalesce(is_set, F.lit(False)).alias("__set"))
    return held.groupBy(*keys).agg(F.bool_and("__set").alias("__all")).filter("__all").select(*keys)


def first_seen_on(feed: DataFrame, table: DataFrame, bits: DataFrame, d, keys: list[str], capacity: int = CAPACITY) -> DataFrame:
    """``first_seen.first_seen_on`` with a filter of the keys seen before d: keys that it can't
    hold are new, the others are looked up in the table."""
    d = to_day(d)
    today = on_day(feed, d).select(*keys).dropna().distinct()
    maybe = maybe_seen(today, bits, keys, capacity)
    looked_up = table.filter(F.col("first_date") < F.lit(d)).select(*keys).join(maybe, keys, "left_semi")
    return today.join(looked_up, keys, "left_anti").withColumn("first_date", F.lit(d))


def backfill(feed: DataFrame, name: str, filter_name: str, up_to, capacity: int = CAPACITY) -> None:
    """First load: the first-seen table and the filter as of day ``up_to``."""
    spark, up_to = feed.sparkSession, to_day(up_to)
    first_seen.backfill_first_seen(feed, name, up_to)
    keys = [c for c in spark.table(name).columns if c != "first_date"]
    seen = spark.table(name).filter(F.col("first_date") <= F.lit(up_to))
    replace_partition(key_bits(seen, keys, capacity), filter_name, as_of=up_to)


def update(feed: DataFrame, name: str, filter_name: str, d, before, capacity: int = CAPACITY) -> None:
    """Write first_date = d of the table and the filter as of d, from day d's events, the
    filter as of ``before`` (the day that ran last) and the rows that it can't rule out."""
    spark, d = feed.sparkSession, to_day(d)
    keys = [c for c in spark.table(name).columns if c != "first_date"]
    old = spark.table(filter_name).filter(F.col("as_of") == F.lit(to_day(before)))
    new = first_seen_on(feed, spark.table(name), old, d, keys, capacity).select(*spark.table(name).columns)
    checkpoint_dir(spark)
    new = new.checkpoint()       # the input reads the tables that are written
    overwrite_partitions(new, name)
    merged = (old.select("chunk", "bits").unionByName(key_bits(new, keys, capacity))
              .groupBy("chunk").agg(F.bitmap_or_agg("bits").alias("bits")))
    replace_partition(merged.checkpoint(), filter_name, as_of=d)
