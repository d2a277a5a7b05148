"""Exact quantiles with mergeable sketches before them.

``index_quantile`` shuffles every distinct value. A KLL sketch is a few KB for a key,
whatever its values, is built in the map tasks, can be stored by day and merges; it tells
in which bracket the quantile lies. One pass over the values then counts what lies below
the bracket, one number for a key and task, and only the distinct values inside it are
shuffled and ranked. The result is the exact one: where a sketch erred and the place
falls outside the bracket, the key goes through ``index_quantile``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.operators.experiment.buckets import index_quantile
from feedlens.operators.experiment.prefix import prefix_sums
from feedlens.session import checkpoint_dir

SKETCH_K = 800          # a normalised rank error of about 0.4 %
MARGIN = 0.01           # ranks on either side of the quantile that the bracket takes in


def value_sketches(df: DataFrame, keys: list[str], value: str, k: int = SKETCH_K) -> DataFrame:
    """keys, sketch of the values (NULLs skipped)."""
    return (df.filter(F.col(value).isNotNull()).groupBy(*keys)
            .agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch")))


def merged_sketches(sketches: DataFrame, keys: list[str], k: int = SKETCH_K) -> DataFrame:
    """keys, sketch of the union of stored sketches (of days, parts, ...)."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def brackets(sketches: DataFrame, keys: list[str], q: float, margin: float = MARGIN) -> DataFrame:
    """keys, n, lo, hi: between which values the q-quantile lies, most likely."""
    def at(rank: float):
        return F.kll_sketch_get_quantile_double("sketch", F.lit(min(1.0, max(0.0, rank))))

    return sketches.select(*keys, F.kll_sketch_get_n_double("sketch").alias("__n"), at(q - margin).alias("__lo"), at(q + margin).alias("__hi"))


def inside_brackets(df: DataFrame, bounds: DataFrame, keys: list[str], value: str) -> DataFrame:
    """What is left to rank: keys, __v, __c for the distinct values inside their bracket, and
    one row a key with __v null that counts the values below. Values above go."""
    v = F.col(value).cast("double")
    rows = df.filter(F.col(value).isNotNull()).join(bounds, keys).filter(v <= F.col("__hi"))
    return (rows.groupBy(*keys, F.when(v >= F.col("__lo"), v).alias("__v"))
            .agg(F.count("*").alias("__c"), F.max("__n").alias("__n")))


def sketched_quantile(df: DataFrame, keys: list[str], value: str, q: float, out: str = "quantile",
                      sketches: DataFrame | None = None, margin: float = MARGIN) -> DataFrame:
    """``index_quantile`` of each key (the sorted value at min(floor(q * n), n - 1)) with
    brackets from ``sketches`` (keys, sketch over the same values; None: built here)."""
    checkpoint_dir(df.sparkSession)
    # sketches draw at random: all that follows has to see one and the same bracket of a key
    bounds = brackets(value_sketches(df, keys, value) if sketches is None else sketches, keys, q, margin).checkpoint()
    left = inside_brackets(df, bounds, keys, value)
    below = left.filter("__v IS NULL").select(*keys, F.col("__c").alias("__below"))
    ranked = prefix_sums(left.filter("__v IS NOT NULL"), "__v", "__c", tuple(keys), "__before", "__inside")
    place = F.least(F.floor(F.lit(q) * F.col("__n")), F.col("__n") - 1)
    first = F.col("__before") + F.coalesce("__below", F.lit(0))
    kind = df.schema[value].dataType
    found = (ranked.join(below, keys, "left").filter((first <= place) & (place < first + F.col("__c")))
             .select(*keys, F.col("__v").cast(kind).alias(out)))
    missed = df.join(bounds.select(*keys).join(found.select(*keys), keys, "left_anti"), keys, "left_semi")
    return found.unionByName(index_quantile(missed, keys, value, q, out))
