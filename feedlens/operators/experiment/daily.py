"""Experiment statistics kept by day.

A running experiment is looked at every day, and every look used to read all its days of
events. Here a day's update reads that day's events and the running sums of earlier days:
users active that day get a row with their sums before and after it. What a group's
moments change by follows from those rows alone, so a day adds one row a group to the
moments table: numbers of users, and sums of likes l, views v, l*l, l*v, v*v, and of l/v
and its square. The moments of any prefix of the experiment are the sums of its days'
rows; Welch's test on the raw CTR and on linearized likes follow from them.

A day is one partition of either table, replaced when it is run again; days after a
changed one have to be run again too, since their sums build on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedlens.functions.columns import ratio, to_day
from feedlens.operators.experiment.metrics import user_metrics
from feedlens.operators.experiment.welch import welch_finish
from feedlens.session import checkpoint_dir
from feedlens.sources.sinks import ensure_table, replace_partition

MOMENTS = ["n", "l", "v", "ll", "lv", "vv", "n_ctr"]     # whole numbers
SHARES = ["c", "cc"]                                     # sums of l / v and of its square
METRICS = ("ctr", "linearized_likes")


def ensure_experiment_tables(spark: SparkSession, prefix: str, location: str | None = None) -> None:
    """Tables ``{prefix}_users`` (running sums) and ``{prefix}_moments``, both by event_date."""
    place = {t: f"{location}/{t}" if location else None for t in ("users", "moments")}
    ensure_table(spark, f"{prefix}_users", "exp_group INT, user_id BIGINT, likes BIGINT, views BIGINT, old_likes BIGINT, old_views BIGINT, event_date DATE",
                 ["event_date"], place["users"])
    figures = ", ".join([f"{c} BIGINT" for c in MOMENTS] + [f"{c} DOUBLE" for c in SHARES])
    ensure_table(spark, f"{prefix}_moments", f"exp_group INT, {figures}, event_date DATE", ["event_date"], place["moments"])


def running_sums(feed: DataFrame, users: DataFrame, groups, start, d) -> DataFrame:
    """Users of ``groups`` active on day d, with their sums since ``start`` (after day d) and
    the old ones (before it; null: not seen). ``users``: the table of the days before."""
    today = user_metrics(feed, groups, d, d).select("exp_group", "user_id", F.col("likes").alias("l"), F.col("views").alias("v"))
    earlier = users.filter((F.col("event_date") >= F.lit(to_day(start))) & (F.col("event_date") < F.lit(to_day(d))))
    newest = earlier.groupBy("exp_group", "user_id").agg(F.max_by(F.struct("likes", "views"), "event_date").alias("old"))
    same = F.col("t.exp_group").eqNullSafe(F.col("e.exp_group")) & F.col("t.user_id").eqNullSafe(F.col("e.user_id"))
    both = today.alias("t").join(newest.alias("e"), same, "left")
    old_likes, old_views = F.col("old.likes"), F.col("old.views")
    return both.select("t.exp_group", "t.user_id", (F.col("l") + F.coalesce(old_likes, F.lit(0))).alias("likes"),
                       (F.col("v") + F.coalesce(old_views, F.lit(0))).alias("views"),
                       old_likes.alias("old_likes"), old_views.alias("old_views"))


def moment_changes(rows: DataFrame) -> DataFrame:
    """What the rows of ``running_sums`` change a group's moments by."""
    def change(of) -> Column:
        new, old = of(F.col("likes"), F.col("views")), of(F.col("old_likes"), F.col("old_views"))
        return F.sum(F.coalesce(new, F.lit(0)) - F.coalesce(old, F.lit(0)))

    terms = {"n": lambda l, v: F.when(l.isNotNull(), 1), "l": lambda l, v: l, "v": lambda l, v: v, "ll": lambda l, v: l * l,
             "lv": lambda l, v: l * v, "vv": lambda l, v: v * v, "n_ctr": lambda l, v: F.when(v > 0, 1),
             "c": lambda l, v: ratio(l, v), "cc": lambda l, v: ratio(l, v) * ratio(l, v)}
    return rows.groupBy("exp_group").agg(*[change(of).cast("double" if name in SHARES else "bigint").alias(name) for name, of in terms.items()])


def update_experiment(feed: DataFrame, prefix: str, groups, start, d) -> None:
    """Replace day d in both tables; reads the events of day d only."""
    spark, d = feed.sparkSession, to_day(d)
    users, moments = f"{prefix}_users", f"{prefix}_moments"
    checkpoint_dir(spark)
    rows = running_sums(feed, spark.table(users), groups, start, d).checkpoint()   # the input reads the table that is written
    replace_partition(rows, users, event_date=d)
    written = spark.table(users).filter(F.col("event_date") == F.lit(d))
    replace_partition(moment_changes(written), moments, event_date=d)


def running_moments(moments: DataFrame, start, hi) -> DataFrame:
    """Date, exp_group and the moments of start..Date for each day up to ``hi``. One row a day
    and group is summed up; a group without rows on a day has the moments of the day before."""
    start, hi = to_day(start), to_day(hi)
    rows = moments.filter(F.col("event_date").between(F.lit(start), F.lit(hi)))
    days = F.sequence(F.lit(start), F.lit(hi))
    spine = rows.select("exp_group").distinct().select("exp_group", F.explode(days).alias("Date"))      # days x groups
    filled = spine.join(rows.withColumnRenamed("event_date", "Date"), ["Date", "exp_group"], "left")
    until = Window.partitionBy("exp_group").orderBy("Date")
    return filled.select("Date", "exp_group", *[F.coalesce(F.sum(c).over(until), F.lit(0)).alias(c) for c in MOMENTS + SHARES])


def _mean_and_variance(n: Column, total: Column, squares: Column) -> tuple[Column, Column]:
    """Mean and sample variance from sums (null below one and two values)."""
    mean = F.when(n > 0, total / n)
    return mean, F.when(n > 1, F.greatest(F.lit(0.0), squares - n * mean * mean) / (n - 1))


def welch_running(moments: DataFrame, start, hi, a, b, control=None) -> DataFrame:
    """Date, metric (raw ctr, linearized_likes), n_a, n_b, means, variances, n_undefined, t, df
    for each day's prefix of the experiment, from the moments table alone. Linearized likes
    use the CTR of ``control`` (default: a) over the same days."""
    control = a if control is None else control
    run = running_moments(moments, start, hi)

    def of(group, name):
        return F.max(F.when(F.col("exp_group") == group, F.col(name))).cast("double").alias(f"{name}_{group}")

    wide = run.groupBy("Date").agg(*[of(g, m) for g in {a, b, control} for m in MOMENTS + SHARES])
    theta = ratio(f"l_{control}", f"v_{control}")

    def figures(g) -> dict[str, tuple]:
        c = {m: F.coalesce(F.col(f"{m}_{g}"), F.lit(0.0)) for m in MOMENTS + SHARES}
        lin = c["l"] - theta * c["v"], c["ll"] - 2 * theta * c["lv"] + theta * theta * c["vv"]
        return {"ctr": (c["n_ctr"], c["c"], c["cc"], c["n"] - c["n_ctr"]),
                "linearized_likes": (F.when(theta.isNotNull(), c["n"]).otherwise(0.0), *lin, F.when(theta.isNull(), c["n"]).otherwise(0.0))}

    parts = []
    for metric in METRICS:
        (n_a, s_a, q_a, u_a), (n_b, s_b, q_b, u_b) = figures(a)[metric], figures(b)[metric]
        (mean_a, var_a), (mean_b, var_b) = _mean_and_variance(n_a, s_a, q_a), _mean_and_variance(n_b, s_b, q_b)
        parts.append(F.struct(F.lit(metric).alias("metric"), n_a.cast("bigint").alias("n_a"), n_b.cast("bigint").alias("n_b"),
                              mean_a.alias("mean_a"), mean_b.alias("mean_b"), var_a.alias("var_a"), var_b.alias("var_b"),
                              (u_a + u_b).cast("bigint").alias("n_undefined")))
    return welch_finish(wide.select("Date", F.explode(F.array(*parts)).alias("m")).select("Date", "m.*"))
