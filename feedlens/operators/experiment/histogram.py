"""Histogram data with bins shared across groups (T9); rendering is left out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def histogram(df: DataFrame, value: str, by: str | None = "exp_group", bins: int = 20,
              lo: float | None = None, hi: float | None = None) -> DataFrame:
    """by, bin (0-based), bin_lo, bin_hi, n: all ``bins`` of every ``by`` that has values,
    the empty ones with n = 0. Equal widths over the overall min..max (scalar
    subqueries) or over lo..hi; the maximum falls in the last bin."""
    if bins < 1:
        raise ValueError("bins must be >= 1")
    base = df.filter(F.col(value).isNotNull())
    v = F.col(value).cast("double")
    if lo is None or hi is None:
        rng = base.agg(F.struct(F.min(v).alias("lo"), F.max(v).alias("hi"))).scalar()  # one pass
        lo, hi = rng.getField("lo"), rng.getField("hi")
    else:
        lo, hi = F.lit(float(lo)), F.lit(float(hi))
    width = hi - lo
    pos = F.greatest(F.floor((v - lo) / width * bins), F.lit(0))
    b = F.when(width > 0, F.least(pos, F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")
    keys = [by] if by else []
    counts = base.groupBy(*keys, b.alias("bin")).agg(F.count("*").alias("n"))
    # the spine: each key's counts as a map, looked up for every bin
    whole = counts.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("found"))   # at most ``bins`` entries
    every = whole.select(*keys, "found", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return every.select(*keys, "bin",
                        (lo + F.col("bin") * width / bins).alias("bin_lo"),
                        (lo + (F.col("bin") + 1) * width / bins).alias("bin_hi"),
                        F.coalesce(F.col("found")[F.col("bin")], F.lit(0)).cast("bigint").alias("n"))
