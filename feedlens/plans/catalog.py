"""Named queries over the test fixture: the registry behind ``__spark_entry__``.

Every query reads ``{sf_dir}/events.parquet`` through the fixture views and runs
over the whole table. Double columns are rounded to 6 places so results compare
across engines; the operators themselves never round.
"""

from __future__ import annotations

import datetime as dt
import functools
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.functions.columns import round_doubles
from feedlens.operators import anomaly, audience, cube, filters, kpi
from feedlens.operators import experiment as ex
from feedlens.plans import ab, jobs, reports
from feedlens.session import checkpoint_dir
from feedlens.sources.fixtures import feed_from_events, load_fixture, messages_from_events
from feedlens.sources.tables import TableRef, read_feed, read_messages
from feedlens.streaming import start_slot_job, stream_events

# The fixture's parameters.
RUN_DATE = dt.date(2024, 1, 9)            # reports and cube run "today"; yesterday = 2024-01-08
YESTERDAY = RUN_DATE - dt.timedelta(days=1)
AS_OF = dt.datetime(2024, 1, 9, 12, 7, 0)  # anomaly job time
ALERT_RUNS = [dt.datetime(2024, 1, 9, h, m) for h, m in ((2, 31), (12, 7), (12, 7), (17, 50), (23, 1))]
WEEKLY_RUN_DATE = dt.date(2024, 1, 30)
AB_LO, AB_HI = dt.date(2024, 1, 8), dt.date(2024, 1, 14)
AA_LO, AA_HI = dt.date(2024, 1, 1), dt.date(2024, 1, 7)
AB_A, AB_B = 1, 2                          # control, test
LIN_EXPERIMENTS = [("0_vs_3", 0, 3), ("2_vs_1", 2, 1)]  # (name, a, b); control = the group in {0, 1}
LIN_CONTROL = {"0_vs_3": 0, "2_vs_1": 1}
AA_A, AA_B = 2, 3
AA_ITER = 10000
AA_K = 10   # users per group and A/A iteration
ALPHA_SMOOTH = 5.0
N_BUCKETS = 50
N_BOOT = 2000
HIST_BINS = 20
SEED = 0
N_PAIRS = 10000
ORACLE_HASH = "md5"


Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(name: str):
    """Register an operator composition as a named catalog query over the fixture."""
    def deco(fn: Callable[[DataFrame, DataFrame, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            feed, msgs = load_fixture(spark, sf_dir)
            return round_doubles(fn(feed, msgs, sf_dir), 6)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        _REGISTRY[name] = run
        return fn
    return deco


def registry() -> dict[str, Query]:
    """Name -> callable(spark, sf_dir) for every registered query."""
    return dict(_REGISTRY)


def _scratch(spark: SparkSession, name: str) -> tuple[str, str]:
    """A fresh table name and its folder in the shared checkpoint folder."""
    name = f"{name}_{uuid.uuid4().hex}"
    return name, os.path.join(checkpoint_dir(spark), name)


# ------------------------------------------------------------------ reports
@query("feed_kpis_day")
def _feed_kpis_day(feed, msgs, sf):
    return kpi.feed_kpis(feed, YESTERDAY)


@query("feed_kpis_week")
def _feed_kpis_week(feed, msgs, sf):
    return kpi.feed_kpis(feed, RUN_DATE - dt.timedelta(days=6), RUN_DATE)


@query("feed_report")
def _feed_report(feed, msgs, sf):
    return reports.feed_report(feed, RUN_DATE)


@query("active_users")
def _active_users(feed, msgs, sf):
    return kpi.active_users(feed, YESTERDAY)


@query("new_users")
def _new_users(feed, msgs, sf):
    return kpi.new_users(feed, YESTERDAY)


@query("new_users_by_source")
def _new_users_by_source(feed, msgs, sf):
    return kpi.new_users_by_source(feed, YESTERDAY)


@query("new_posts")
def _new_posts(feed, msgs, sf):
    return kpi.new_posts(feed, YESTERDAY)


@query("avg_activity_14d")
def _avg_activity(feed, msgs, sf):
    return kpi.avg_activity(feed, RUN_DATE, 14)


@query("hourly_users")
def _hourly_users(feed, msgs, sf):
    return kpi.hourly_users(feed, msgs, YESTERDAY)


@query("app_report")
def _app_report(feed, msgs, sf):
    return reports.app_report(feed, RUN_DATE)


@query("app_report_maintained")
def _app_report_maintained(feed, msgs, sf):
    """K15 from first-seen tables: filled with the history before yesterday, then brought up
    to date by the job, whose report reads yesterday's partitions only."""
    spark = feed.sparkSession
    prefix, path = _scratch(spark, "seen")
    jobs.maintained_first_seen(spark, feed, YESTERDAY - dt.timedelta(days=1), prefix, path)
    return jobs.app_report_job(spark, feed, msgs, RUN_DATE, first_seen_prefix=prefix, first_seen_location=path,
                               since=YESTERDAY).summary


# ------------------------------------------------------------------ cube
@query("feed_by_user")
def _feed_by_user(feed, msgs, sf):
    return cube.feed_by_user(feed, YESTERDAY, age_bins="reference")


@query("messages_by_user")
def _messages_by_user(feed, msgs, sf):
    return cube.messages_by_user(msgs, YESTERDAY)


@query("daily_cube")
def _daily_cube(feed, msgs, sf):
    return cube.daily_cube(feed, msgs, RUN_DATE, age_bins="reference")


@query("daily_cube_fixed_age")
def _daily_cube_fixed(feed, msgs, sf):
    return cube.daily_cube(feed, msgs, RUN_DATE, age_bins="fixed")


@query("daily_cube_dedupe_messages")
def _daily_cube_dedupe(feed, msgs, sf):
    return cube.daily_cube(feed, msgs, RUN_DATE, age_bins="reference", dedupe_messages=True)


# ------------------------------------------------------------------ audience
@query("weekly_audience")
def _weekly_audience(feed, msgs, sf):
    return audience.weekly_audience(feed, WEEKLY_RUN_DATE)


@query("weekly_audience_wide")
def _weekly_audience_wide(feed, msgs, sf):
    return audience.weekly_audience_wide(feed, WEEKLY_RUN_DATE)


# ------------------------------------------------------------------ anomalies
def _scored(feed, msgs, mode):
    slots = anomaly.slot_metrics(feed, msgs, AS_OF)
    return anomaly.iqr_bounds(anomaly.unpivot_metrics(slots), a=2.0, n=6, mode=mode)


@query("slot_metrics")
def _slot_metrics(feed, msgs, sf):
    return anomaly.slot_metrics(feed, msgs, AS_OF)


@query("iqr_bounds_centred")
def _iqr_centred(feed, msgs, sf):
    return _scored(feed, msgs, "centred")


@query("iqr_bounds_newest")
def _iqr_newest(feed, msgs, sf):
    return _scored(feed, msgs, "newest")


@query("current_alerts")
def _current_alerts(feed, msgs, sf):
    return anomaly.current_alerts(_scored(feed, msgs, "newest"))


@query("alert_series")
def _alert_series(feed, msgs, sf):
    return anomaly.alert_series(_scored(feed, msgs, "centred"))


# ------------------------------------------------------------------ experiments
def _ab_users(feed):
    return ex.user_metrics(feed, (AB_A, AB_B), AB_LO, AB_HI)


@query("user_metrics")
def _user_metrics(feed, msgs, sf):
    return _ab_users(feed)


@query("global_ctr")
def _global_ctr(feed, msgs, sf):
    return ex.group_totals(_ab_users(feed), (AB_A, AB_B))


@query("smoothed_ctr")
def _smoothed_ctr(feed, msgs, sf):
    return ex.smoothed_ctr(_ab_users(feed), (AB_A, AB_B), ALPHA_SMOOTH)


@query("linearized_likes")
def _linearized_likes(feed, msgs, sf):
    um = ex.user_metrics(feed, (0, 3), AB_LO, AB_HI)
    return ex.linearized_likes(um, (0, 3), 0)


def _welch_cols(df):
    return df.select("n_a", "n_b", "mean_a", "mean_b", "var_a", "var_b", "n_undefined", "t", "df")


@query("welch_stats_raw")
def _welch_raw(feed, msgs, sf):
    return _welch_cols(ex.welch_stats(_ab_users(feed), "ctr", AB_A, AB_B))


@query("welch_stats_smoothed")
def _welch_smoothed(feed, msgs, sf):
    sm = ex.smoothed_ctr(_ab_users(feed), (AB_A, AB_B), ALPHA_SMOOTH)
    return _welch_cols(ex.welch_stats(sm, "smoothed_ctr", AB_A, AB_B))


@query("welch_stats_linearized")
def _welch_linearized(feed, msgs, sf):
    out = None
    for name, a, b in LIN_EXPERIMENTS:
        um = ex.user_metrics(feed, (a, b), AB_LO, AB_HI)
        lin = ex.linearized_likes(um, (a, b), LIN_CONTROL[name])
        st = _welch_cols(ex.welch_stats(lin, "linearized_likes", a, b))
        st = st.select(F.lit(name).alias("experiment"), "*")
        out = st if out is None else out.unionByName(st)
    return out


def _oracle_buckets(feed):
    return ex.bucket_metrics(feed, (AB_A, AB_B), AB_LO, AB_HI, N_BUCKETS, 0.9, ORACLE_HASH)


def _oracle_bucket_ratios(feed):
    return ex.bucket_ratios(_ab_users(feed), N_BUCKETS, ORACLE_HASH)


@query("welch_stats_bucket")
def _welch_bucket(feed, msgs, sf):
    return _welch_cols(ex.welch_stats(_oracle_bucket_ratios(feed), "bucket_ctr", AB_A, AB_B))


@query("mann_whitney_stats_raw")
def _mw_raw(feed, msgs, sf):
    return ex.mann_whitney_stats(_ab_users(feed), "ctr", AB_A, AB_B)


@query("mann_whitney_stats_bucket")
def _mw_bucket(feed, msgs, sf):
    return ex.mann_whitney_stats(_oracle_bucket_ratios(feed), "bucket_ctr", AB_A, AB_B)


@query("prob_superiority")
def _prob_sup(feed, msgs, sf):
    return ex.prob_superiority(_ab_users(feed), "ctr", AB_A, AB_B)


@query("prob_superiority_sampled")
def _prob_sup_sampled(feed, msgs, sf):
    return ex.prob_superiority(_ab_users(feed), "ctr", AB_A, AB_B, n_pairs=N_PAIRS,
                               hash_mode=ORACLE_HASH)


@query("bucket_metrics")
def _bucket_metrics(feed, msgs, sf):
    return _oracle_buckets(feed)


@query("ctr_histogram")
def _ctr_histogram(feed, msgs, sf):
    return ex.histogram(_ab_users(feed), "ctr", "exp_group", HIST_BINS)


@query("bootstrap_replicates")
def _boot_reps(feed, msgs, sf):
    return ex.bootstrap_replicates(_ab_users(feed), AB_A, AB_B, N_BOOT, hash_mode=ORACLE_HASH)


@query("bootstrap_summary")
def _boot_summary(feed, msgs, sf):
    return ex.bootstrap_summary(
        ex.bootstrap_replicates(_ab_users(feed), AB_A, AB_B, N_BOOT, hash_mode=ORACLE_HASH))


def _aa_users(feed):
    return ex.user_metrics(feed, (AA_A, AA_B), AA_LO, AA_HI)


@query("aa_subsample_stats")
def _aa_stats(feed, msgs, sf):
    return ex.aa_stats(_aa_users(feed), AA_A, AA_B, AA_ITER, AA_K, SEED, ORACLE_HASH)


@query("aa_summary")
def _aa_summary(feed, msgs, sf):
    return ex.aa_summary(ex.aa_stats(_aa_users(feed), AA_A, AA_B, AA_ITER, AA_K, SEED, ORACLE_HASH))


@query("aa_pvalue_histogram")
def _aa_pvalue_histogram(feed, msgs, sf):
    """The p-values of the A/A iterations in equal bins of 0..1 (flat if all is well)."""
    p = ex.aa_pvalues(ex.aa_stats(_aa_users(feed), AA_A, AA_B, AA_ITER, AA_K, SEED, ORACLE_HASH))
    return ex.histogram(p, "p_value", None, HIST_BINS, 0.0, 1.0)


@query("bootstrap_histogram")
def _bootstrap_histogram(feed, msgs, sf):
    """The bootstrap differences."""
    reps = ex.bootstrap_replicates(_ab_users(feed), AB_A, AB_B, N_BOOT, SEED, ORACLE_HASH)
    return ex.histogram(reps, "diff", None, HIST_BINS)


@query("welch_stats_raw_pairs")
def _welch_raw_pairs(feed, msgs, sf):
    """T1 on the raw CTR of the pairs of the linearized-likes experiments."""
    parts = [_welch_cols(ex.welch_stats(ex.user_metrics(feed, (a, b), AB_LO, AB_HI), "ctr", a, b)).select(F.lit(name).alias("experiment"), "*")
             for name, a, b in LIN_EXPERIMENTS]
    return functools.reduce(DataFrame.unionByName, parts)


@query("ab_summary")
def _ab_summary(feed, msgs, sf):
    return ab.ab_summary(feed, AB_A, AB_B, AB_LO, AB_HI, ALPHA_SMOOTH, N_BUCKETS, N_BOOT, SEED, ORACLE_HASH)


# ------------------------------------------------------------------ sources and sinks
@query("feed_scan")
def _feed_scan(feed, msgs, sf):
    """Both tables written out and read back by path and by table name."""
    spark, parts = feed.sparkSession, []
    for kind, df, read in (("feed", feed, read_feed), ("messages", msgs, read_messages)):
        name, path = _scratch(spark, f"scan_{kind}")
        df.withColumn("extra", F.lit(1)).write.parquet(path)
        spark.read.parquet(path).createOrReplaceTempView(name)
        for how, source in (("path", TableRef(path=path)), ("name", TableRef(name=name))):
            parts.append(read(spark, source).groupBy(F.to_date("time").alias("day")).agg(
                F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))
                .select(F.lit(kind).alias("kind"), F.lit(how).alias("how"), "day", "n", "users"))
    return functools.reduce(DataFrame.unionByName, parts)


@query("cube_rewrite")
def _cube_rewrite(feed, msgs, sf):
    """A day written twice (the second time from iOS users only), a day written
    and then emptied, and a day left alone."""
    spark = feed.sparkSession
    name, path = _scratch(spark, "cube")
    day = dt.timedelta(days=1)
    jobs.daily_cube_job(spark, feed, msgs, RUN_DATE - 2 * day, name, path, "reference")
    jobs.daily_cube_job(spark, feed, msgs, RUN_DATE - day, name, path, "reference")
    jobs.daily_cube_job(spark, feed, msgs, RUN_DATE, name, path, "reference")
    jobs.daily_cube_job(spark, feed.filter("os = 'iOS'"), msgs, RUN_DATE, name, path, "reference")
    jobs.daily_cube_job(spark, feed.filter("false"), msgs, RUN_DATE - day, name, path, "reference")
    return spark.table(name)


@query("alert_history")
def _alert_history(feed, msgs, sf):
    """The alert job at several times of one day, one of them run twice; every slot's
    alerts stay, each with its run time."""
    spark = feed.sparkSession
    name, path = _scratch(spark, "alerts")
    for as_of in ALERT_RUNS:
        jobs.anomaly_alert_job(spark, feed, msgs, as_of, name, path)
    return spark.table(name).select("report_date", "kind", "slot", "run_ts", "text")


# ------------------------------------------------------------------ streaming
def _run_stream(spark: SparkSession, sf_dir: str) -> str:
    """The events file as a stream through the slot job; the folder of its output."""
    ev = stream_events(spark, sf_dir)
    out = os.path.join(checkpoint_dir(spark), f"stream-slots-{uuid.uuid4().hex}")
    q = start_slot_job(spark, feed_from_events(spark, ev), messages_from_events(spark, ev), out,
                       checkpoint=os.path.join(out, "_checkpoint"))
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return out


def _stream_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed 15-minute slots as the foreachBatch sink wrote them."""
    cols = ["ts", "date", "hm", "users_feed", "views", "likes", "CTR", "users_mess", "sent_mess"]
    return round_doubles(spark.read.parquet(os.path.join(_run_stream(spark, sf_dir), "slots")).select(*cols), 6)


def _stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scored rows of every slot that the stream closed."""
    return round_doubles(spark.read.parquet(os.path.join(_run_stream(spark, sf_dir), "alerts")).drop("epoch", "batch_id"), 6)


_REGISTRY["stream_slot_metrics"] = _stream_slots
_REGISTRY["stream_alerts"] = _stream_alerts

from feedlens.plans import maintained  # noqa: E402,F401 - registers its queries here
