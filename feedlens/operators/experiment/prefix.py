"""Prefix sums over sorted values without one task for all of them.

A value's place on a logarithmic scale, which keeps the order, gives it a fine bucket
and, 2**16 fine buckets together, a coarse one. Sums run over the coarse buckets, over the
fine ones inside a coarse one, and over the values inside a fine one; no window is wider
than that. There are at most some 10**5 coarse buckets for any doubles at all (128 for
each doubling of the value), so their table is small whatever the data. Nothing has to be
sampled or run while the plan is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FINE_BITS = 16


def fine_bucket(v: Column) -> Column:
    """A bigint that never falls when v rises; 2**23 for each doubling of |v|."""
    scale = F.log2(F.lit(1.0) + F.abs(v) * float(2 ** 30))
    return F.floor(F.signum(v) * scale * float(2 ** (7 + FINE_BITS))).cast("bigint")


def prefix_sums(counts: DataFrame, value: str, weight: str, keys: tuple[str, ...] = (), out: str = "before",
                total: str | None = None) -> DataFrame:
    """``counts`` (one row per key and value) and ``out``: the weights of the key's smaller
    values together; ``total``: those of all its values. Rows with a NULL value go."""
    keys = list(keys)
    c = (counts.filter(F.col(value).isNotNull()).withColumn("_fine", fine_bucket(F.col(value)))
         .withColumn("_coarse", F.shiftright("_fine", FINE_BITS)))
    before = (Window.unboundedPreceding, -1)
    fine = c.groupBy(*keys, "_coarse", "_fine").agg(F.sum(weight).alias("_w"))
    coarse = fine.groupBy(*keys, "_coarse").agg(F.sum("_w").alias("_w"))
    whole = Window.partitionBy(*keys)
    coarse = coarse.select(*keys, "_coarse", F.sum("_w").over(whole.orderBy("_coarse").rowsBetween(*before)).alias("_in_coarse"),
                           F.sum("_w").over(whole).alias("_total"))
    fine = fine.select(*keys, "_coarse", "_fine", F.sum("_w").over(
        Window.partitionBy(*keys, "_coarse").orderBy("_fine").rowsBetween(*before)).alias("_in_fine"))
    offsets = fine.join(coarse, [*keys, "_coarse"]).select(
        *keys, "_fine", (F.coalesce("_in_coarse", F.lit(0)) + F.coalesce("_in_fine", F.lit(0))).alias("_offset"), "_total")
    inside = F.sum(weight).over(Window.partitionBy(*keys, "_fine").orderBy(value).rowsBetween(*before))
    return (c.withColumn("_inside", F.coalesce(inside, F.lit(0))).join(offsets, [*keys, "_fine"])
            .select(*counts.columns, (F.col("_offset") + F.col("_inside")).alias(out),
                    *([F.col("_total").alias(total)] if total else [])))
