"""Per-user experiment metrics and ratio transforms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions.columns import ratio
from feedlens.operators.filters import between_dates, in_groups


def user_metrics(feed: DataFrame, groups, lo, hi) -> DataFrame:
    """exp_group, user_id, likes, views, ctr over the closed date range (K1).

    ctr is NULL for users with likes but no views (D2).
    """
    return (in_groups(between_dates(feed, lo, hi), groups)
            .groupBy("exp_group", "user_id")
            .agg(F.count_if(F.col("action") == "like").alias("likes"),
                 F.count_if(F.col("action") == "view").alias("views"))
            .select("exp_group", "user_id", "likes", "views", ratio("likes", "views").alias("ctr")))


def group_totals(um: DataFrame, groups, group_col: str = "exp_group") -> DataFrame:
    """Per group: users, likes, views, global_ctr = sum(likes)/sum(views), and the
    number of users whose own ctr is undefined (A6). At most len(groups) rows."""
    return (in_groups(um, groups, group_col)
            .groupBy(group_col)
            .agg(F.count("*").alias("users"),
                 F.sum("likes").alias("likes"), F.sum("views").alias("views"),
                 F.count_if(F.col("ctr").isNull()).alias("n_undefined"))
            .withColumn("global_ctr", ratio("likes", "views")))


def smoothed_ctr(um: DataFrame, groups, alpha: float = 5.0, group_col: str = "exp_group") -> DataFrame:
    """(likes + alpha * G) / (views + alpha) with G the user's own group's global CTR (T4).

    The totals side has at most len(groups) rows (the input is filtered to
    ``groups``), so broadcasting it is safe at any data size; the big side is never
    shuffled by group (which would put a whole group in one task).
    """
    um = in_groups(um, groups, group_col)
    totals = group_totals(um, groups, group_col).select(group_col, "global_ctr")
    return (um.join(F.broadcast(totals), group_col)
            .select(group_col, "user_id", "likes", "views", "ctr",
                    ((F.col("likes") + F.lit(float(alpha)) * F.col("global_ctr"))
                     / (F.col("views") + F.lit(float(alpha)))).alias("smoothed_ctr")))


def control_ctr(um: DataFrame, control, group_col: str = "exp_group"):
    """Scalar-subquery column: the control group's sum(likes)/sum(views)."""
    return (um.filter(F.col(group_col) == control)
            .agg(ratio(F.sum("likes"), F.sum("views")).alias("c")).scalar())


def linearized_likes(um: DataFrame, groups, control, group_col: str = "exp_group") -> DataFrame:
    """likes - CTR_control * views for every user of ``groups``.

    CTR_control is an uncorrelated scalar subquery: computed once, then a literal
    inside the projection (no join, no driver round trip in user code).
    """
    um = in_groups(um, groups, group_col)
    return um.select(group_col, "user_id", "likes", "views",
                     (F.col("likes") - control_ctr(um, control, group_col) * F.col("views"))
                     .alias("linearized_likes"))
