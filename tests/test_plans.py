"""Physical-plan properties that matter at scale (checked at sf0.01)."""

import pytest

from feedlens.plans.catalog import registry

from fixture_paths import SF001


# queries that run a sink or a stream first: their plans are those of reading it back
RUNS = {"stream_slot_metrics", "stream_alerts", "alert_history", "cube_rewrite", "feed_scan", "app_report_maintained"}


def _plan(df) -> str:
    spark = df.sparkSession
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    jvm = spark.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", ["feed_kpis_day", "daily_cube", "slot_metrics", "user_metrics",
                                  "hourly_users", "weekly_audience"])
def test_time_filter_reaches_the_scan(spark, name):
    plan = _plan(registry()[name](spark, SF001))
    assert "PushedFilters: [IsNotNull(ts)" in plan or "LessThan(ts," in plan
    assert "In(event_type," in plan


@pytest.mark.parametrize("name", sorted(set(registry()) - {"aa_summary", "aa_pvalue_histogram", "ab_summary", "mann_whitney_exact"} - RUNS))
def test_no_row_at_a_time_python(spark, name):
    plan = _plan(registry()[name](spark, SF001))
    assert "BatchEvalPython" not in plan
    assert "ArrowEvalPython" not in plan


@pytest.mark.parametrize("name", ["feed_kpis_week", "daily_cube", "weekly_audience", "user_metrics",
                                  "bootstrap_replicates", "feed_by_user", "messages_by_user"])
def test_no_single_partition_exchange(spark, name):
    plan = _plan(registry()[name](spark, SF001))
    assert "SinglePartition" not in plan


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(registry()["messages_by_user"](spark, SF001))
    scan = [ln for ln in plan.splitlines() if "ReadSchema" in ln or "FileScan" in ln]
    assert scan and all("value" not in ln and "props" not in ln for ln in scan)


def test_pvalue_udf_runs_after_aggregation(spark):
    plan = _plan(registry()["aa_summary"](spark, SF001))
    # the Arrow UDF sits above the per-iteration aggregate, not on raw rows
    udf_at = plan.find("ArrowEvalPython")
    assert udf_at != -1 and plan.find("HashAggregate", udf_at) != -1


@pytest.mark.parametrize("name", ["slot_metrics", "weekly_audience", "messages_by_user", "hourly_users",
                                  "app_report"])
def test_no_join_where_the_design_avoids_one(spark, name):
    plan = _plan(registry()[name](spark, SF001))
    for join in ("SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "CartesianProduct",
                 "BroadcastNestedLoopJoin"):
        assert join not in plan, (name, join)


@pytest.mark.parametrize("name", sorted(set(registry()) - RUNS))
def test_no_cross_join_anywhere(spark, name):
    plan = _plan(registry()[name](spark, SF001))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["aa_subsample_stats", "prob_superiority_sampled", "bootstrap_replicates"])
def test_draws_do_not_multiply_users(spark, name):
    """Rows made by the plan's generators: draws, or distinct tuples x replicates."""
    from feedlens.operators.experiment import draws
    plan = _plan(registry()[name](spark, SF001))
    assert "user_id" not in "".join(ln for ln in plan.splitlines() if "Arguments: explode(sequence" in ln)
    assert draws.MISS <= 1e-12


def test_first_seen_report_reads_its_day_only(spark, tmp_path):
    import datetime as dt

    from feedlens.plans import jobs, reports
    from feedlens.sources.fixtures import load_fixture
    feed, _ = load_fixture(spark, SF001)
    feed.withColumn("event_date", feed.time.cast("date")).write.partitionBy("event_date").parquet(str(tmp_path / "feed"))
    from feedlens.sources import read_feed
    feed = read_feed(spark, str(tmp_path / "feed"))
    seen = jobs.maintained_first_seen(spark, feed, dt.date(2024, 1, 8), "plan_seen", str(tmp_path / "seen"))
    plan = _plan(reports.app_report(feed, dt.date(2024, 1, 9), seen))
    scans = [ln for ln in plan.splitlines() if "PartitionFilters" in ln]
    assert len(scans) == 4 and all("2024-01-08" in ln for ln in scans)
    for what in jobs.FIRST_SEEN_KEYS:
        spark.sql(f"DROP TABLE IF EXISTS plan_seen_{what}")
