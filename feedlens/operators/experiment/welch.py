"""Welch's unequal-variance t-test from conditional aggregates.

One pass computes count / mean / sample variance of both groups (partial
aggregates per task, one merge); t and the Satterthwaite df are column
expressions. ``keys`` gives one test per key (e.g. per A/A iteration).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions.pvalue import t_pvalue

STAT_COLS = ["n_a", "n_b", "mean_a", "mean_b", "var_a", "var_b", "t", "df"]


AGG_NAMES = ["n_a", "n_b", "mean_a", "mean_b", "var_a", "var_b", "n_undefined"]


def _welch_exprs(value: str, a, b, group_col: str = "exp_group"):
    g, v = F.col(group_col), F.col(value)
    va, vb = F.when(g == a, v), F.when(g == b, v)
    return [F.count(va), F.count(vb), F.avg(va), F.avg(vb), F.var_samp(va), F.var_samp(vb),
            F.count_if(g.isin(a, b) & v.isNull())]


def welch_aggs(value: str, a, b, group_col: str = "exp_group"):
    """Aggregates n, mean and sample variance of both groups (+ n_undefined)."""
    return [e.alias(n) for n, e in zip(AGG_NAMES, _welch_exprs(value, a, b, group_col))]


def welch_finish(df: DataFrame) -> DataFrame:
    """Add t and the Welch-Satterthwaite df to per-group n / mean / var columns."""
    se_a = F.col("var_a") / F.col("n_a")
    se_b = F.col("var_b") / F.col("n_b")
    t = F.try_divide(F.col("mean_a") - F.col("mean_b"), F.sqrt(se_a + se_b))
    dof = F.try_divide((se_a + se_b) * (se_a + se_b),
                       se_a * se_a / (F.col("n_a") - 1) + se_b * se_b / (F.col("n_b") - 1))
    return df.withColumn("t", t).withColumn("df", dof)


def welch_stats(df: DataFrame, value: str, a, b, group_col: str = "exp_group",
                keys=None) -> DataFrame:
    """n, mean, var of a and b, t = (mean_a - mean_b)/se, df; sign follows (a, b).

    NULL values are excluded and counted in n_undefined (D2).
    """
    aggs = welch_aggs(value, a, b, group_col)
    base = df.filter(F.col(group_col).isin(a, b))
    out = base.groupBy(*keys).agg(*aggs) if keys else base.agg(*aggs)
    return welch_finish(out)


def welch_stats_many(df: DataFrame, values: list[str], a, b,
                     group_col: str = "exp_group") -> DataFrame:
    """welch_stats for several metric columns of one frame in a single aggregation
    pass; one row per metric (column ``metric``)."""
    base = df.filter(F.col(group_col).isin(a, b))
    one = base.agg(*[e.alias(f"{v}__{n}") for v in values
                     for n, e in zip(AGG_NAMES, _welch_exprs(v, a, b, group_col))])
    parts = ", ".join(f"'{v}', " + ", ".join(f"`{v}__{n}`" for n in AGG_NAMES) for v in values)
    long = one.selectExpr(f"stack({len(values)}, {parts}) AS (metric, {', '.join(AGG_NAMES)})")
    return welch_finish(long)


def welch_test(df: DataFrame, value: str, a, b, group_col: str = "exp_group",
               keys=None) -> DataFrame:
    """welch_stats plus the two-sided p_value."""
    st = welch_stats(df, value, a, b, group_col, keys)
    return st.withColumn("p_value", t_pvalue(F.col("t"), F.col("df")))
