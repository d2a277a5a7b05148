import datetime as dt

from pyspark.sql import functions as F

from feedlens.operators import anomaly, kpi
from feedlens.operators.first_seen import (
    backfill_first_seen, count_first_seen, ensure_first_seen_table, update_first_seen,
)
from feedlens.sources.fixtures import load_fixture

from fixture_paths import SF001


def test_active_users_population_either(make_feed, make_msgs):
    feed = make_feed([(1, "2024-01-08 10:00:00", "view", 0, 1, "iOS", "ads", 1, 30),
                      (2, "2024-01-08 10:00:00", "view", 0, 1, "iOS", "ads", 1, 30)])
    msgs = make_msgs([(2, 5, "2024-01-08 11:00:00"), (3, 5, "2024-01-08 11:00:00"),
                      (4, 5, "2024-01-09 11:00:00")])
    assert kpi.active_users(feed, "2024-01-08").first().total == 2
    assert kpi.active_users(feed, "2024-01-08", population="either", msgs=msgs).first().total == 3


def test_slot_metrics_fill_gaps(make_feed, make_msgs):
    feed = make_feed([(1, "2024-01-08 00:01:00", "view", 0, 1, "iOS", "ads", 1, 30),
                      (2, "2024-01-08 00:20:00", "like", 0, 1, "iOS", "ads", 1, 30)])
    msgs = make_msgs([(1, 2, "2024-01-08 00:05:00")])
    rows = anomaly.slot_metrics(feed, msgs, "2024-01-09 12:07:00", fill_gaps=True).orderBy("ts").collect()
    assert len(rows) == 4 * 36                       # 2024-01-08 00:00 .. 2024-01-09 11:45
    assert (rows[0].views, rows[0].users_mess) == (1, 1)
    assert (rows[1].likes, rows[1].users_mess, rows[1].CTR) == (1, 0, None)
    assert (rows[2].users_feed, rows[2].sent_mess) == (0, 0)
    assert len(anomaly.slot_metrics(feed, msgs, "2024-01-09 12:07:00").collect()) == 1


def test_first_seen_tables_match_full_history(spark, tmp_path):
    feed, _ = load_fixture(spark, SF001)
    cases = [("fs_users", ["user_id"], {"user_id": "BIGINT"}, kpi.new_users, "new_users"),
             ("fs_posts", ["post_id"], {"post_id": "BIGINT"}, kpi.new_posts, "new_posts")]
    for name, keys, types, full, col in cases:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        ensure_first_seen_table(spark, name, keys, types, str(tmp_path / name))
        backfill_first_seen(feed, name, "2024-01-05")
        for day in range(6, 10):
            d = dt.date(2024, 1, day)
            update_first_seen(feed, name, d, keys)
            update_first_seen(feed, name, d, keys)       # rerun: same partition, same answer
            want = full(feed, d).first()[col]
            assert count_first_seen(spark, name, d).first().n_new == want, (name, d)
        dup = spark.table(name).groupBy(*keys).count().filter(F.col("count") > 1).count()
        assert dup == 0
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_date_partitioned_input_is_pruned(spark, tmp_path):
    from feedlens.sources import read_feed
    feed, _ = load_fixture(spark, SF001)
    path = str(tmp_path / "feed_by_day")
    feed.withColumn("event_date", F.to_date("time")).write.partitionBy("event_date").parquet(path)
    part = read_feed(spark, path)
    assert "event_date" in part.columns
    q = kpi.feed_kpis(part, "2024-01-08")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(q._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [isnotnull(event_date" in plan and "2024-01-08" in plan
    assert sorted(map(tuple, q.collect())) == sorted(map(tuple, kpi.feed_kpis(feed, "2024-01-08").collect()))


def test_weekly_audience_since_matches_full_history(make_feed, spark):
    from feedlens.operators import audience
    feed, _ = load_fixture(spark, SF001)
    full = audience.weekly_audience(feed, "2024-01-30").filter(F.col("Date") >= "2024-01-15")
    part = audience.weekly_audience(feed, "2024-01-30", since="2024-01-15")
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, part.collect()))


def test_scale_conf_sizes_partitions():
    from feedlens.session import scale_conf
    width = lambda *a, **k: int(scale_conf(*a, **k)["spark.sql.shuffle.partitions"])
    assert width(100 * 2**40, 1000) == 20_000                      # by shuffled bytes, below the ceiling
    assert width(100 * 2**40, 1000, shuffled_share=0.01) == 100 * 2**40 // 100 // (256 << 20) + 1
    assert width(100 * 2**40, 8000) == width(2**30, 8000) == 24_000  # never under 3 waves
    assert scale_conf(2**40, 100)["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_preset_master_and_width_survive(tmp_path):
    import os
    import subprocess
    import sys
    code = ("from feedlens.session import build_session; s = build_session();"
            "print('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions')); s.stop()")
    env = {**os.environ, "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.sql.shuffle.partitions=4000 pyspark-shell"}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120,
                         cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert "GOT local[2] 4000" in out.stdout, out.stderr[-500:]


def test_checkpoint_dir_must_be_set_on_a_cluster(monkeypatch):
    import pytest

    from feedlens import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"
        getConf = staticmethod(Conf)
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context

    monkeypatch.setattr(session.tempfile, "mkdtemp", lambda **k: pytest.fail("a local folder on a cluster"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())
