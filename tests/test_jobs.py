import datetime as dt

from feedlens.plans import jobs
from feedlens.sources.fixtures import load_fixture
from feedlens.operators import kpi
from feedlens.operators.first_seen import backfill_first_seen, ensure_first_seen_table

from fixture_paths import SF001


def test_jobs_write_idempotently(spark, tmp_path):
    feed, msgs = load_fixture(spark, SF001)
    for t in ("job_cube", "job_reports"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    for _ in range(2):
        written = jobs.daily_cube_job(spark, feed, msgs, "2024-01-09", "job_cube", str(tmp_path / "cube"))
        jobs.feed_report_job(spark, feed, "2024-01-09", "job_reports", str(tmp_path / "rep"))
        app = jobs.app_report_job(spark, feed, msgs, "2024-01-09", "job_reports")
        run = jobs.anomaly_alert_job(spark, feed, msgs, "2024-01-09 12:07:00", "job_reports")
    assert written.count() == spark.table("job_cube").count() == 8
    kinds = {r.kind: r["count"] for r in spark.table("job_reports").groupBy("kind").count().collect()}
    assert kinds["feed"] == 1 and kinds["app"] == 1
    assert kinds.get("alert", 0) == run.alerts.filter("text IS NOT NULL").count()
    # as of 2024-01-09 only the week of 2024-01-08 has new, retained and gone users
    assert [r.Date for r in app.audience.collect()] == [dt.date(2024, 1, 8)]
    assert app.hourly.count() > 0 and app.activity.count() == 8
    assert run.series.select("metric").distinct().count() == 6
    for t in ("job_cube", "job_reports"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_alerts_of_other_slots_stay_and_a_rerun_clears_its_own(spark, make_feed, make_msgs, tmp_path):
    spark.sql("DROP TABLE IF EXISTS alert_rows")
    views = [(u, f"2024-01-08 {h:02d}:{m:02d}:00", "view", 0, 1, "iOS", "ads", 1, 30)
             for h in range(9, 13) for m in (0, 15, 30, 45) for u in range(10 if (h, m) not in ((11, 0), (12, 0)) else 40)]
    msgs = make_msgs([(1, 2, f"2024-01-08 {h:02d}:{m:02d}:00") for h in range(9, 13) for m in (0, 15, 30, 45)])
    feed = make_feed(views)
    for as_of in ("2024-01-08 11:15:00", "2024-01-08 12:15:00"):
        jobs.anomaly_alert_job(spark, feed, msgs, as_of, "alert_rows", str(tmp_path / "a"))
    rows = spark.table("alert_rows").collect()
    assert {(r.slot, r.run_ts) for r in rows} == {("11-00", dt.datetime(2024, 1, 8, 11, 15)), ("12-00", dt.datetime(2024, 1, 8, 12, 15))}
    calm = make_feed([v for v in views if not (v[1] == "2024-01-08 12:00:00" and v[0] >= 10)])
    jobs.anomaly_alert_job(spark, calm, msgs, "2024-01-08 12:16:00", "alert_rows")
    assert {r.slot for r in spark.table("alert_rows").collect()} == {"11-00"}
    spark.sql("DROP TABLE IF EXISTS alert_rows")


def test_kpis_from_first_seen_table(spark, tmp_path):
    feed, _ = load_fixture(spark, SF001)
    spark.sql("DROP TABLE IF EXISTS fs_src")
    ensure_first_seen_table(spark, "fs_src", ["user_id", "source"],
                            {"user_id": "BIGINT", "source": "STRING"}, str(tmp_path / "fs"))
    backfill_first_seen(feed, "fs_src", "2024-01-08")
    d = dt.date(2024, 1, 8)
    a = kpi.new_users_by_source(feed, d).first()
    b = kpi.new_users_by_source(feed, d, first_seen=spark.table("fs_src")).first()
    assert (a.ads, a.organic) == (b.ads, b.organic) == (3, 29)     # FIXTURES.md, sf0.01
    assert kpi.new_users(feed, d).first().new_users == 31
    assert kpi.new_posts(feed, d).first().new_posts == 24
    spark.sql("DROP TABLE IF EXISTS fs_src")


def test_cli_runs_jobs(spark, tmp_path, capsys):
    from feedlens.__main__ import main
    feed, msgs = load_fixture(spark, SF001)
    feed.write.parquet(str(tmp_path / "feed"))
    msgs.write.parquet(str(tmp_path / "msgs"))
    spark.sql("DROP TABLE IF EXISTS cli_cube")
    spark.sql("DROP TABLE IF EXISTS cli_reports")
    assert main(["cube", "--feed", str(tmp_path / "feed"), "--messages", str(tmp_path / "msgs"),
                 "--run-date", "2024-01-09", "--table", "cli_cube", "--location", str(tmp_path / "c")]) == 0
    assert main(["feed-report", "--feed", str(tmp_path / "feed"), "--run-date", "2024-01-09",
                 "--table", "cli_reports", "--location", str(tmp_path / "r")]) == 0
    out = capsys.readouterr().out
    assert "wrote 8 cube rows" in out and "Feed summary for 2024-01-08" in out
    spark.sql("DROP TABLE IF EXISTS cli_cube")
    spark.sql("DROP TABLE IF EXISTS cli_reports")


def test_cli_stream_once(spark, tmp_path):
    from feedlens.__main__ import main
    feed, msgs = load_fixture(spark, SF001)
    feed.write.parquet(str(tmp_path / "feed"))
    msgs.write.parquet(str(tmp_path / "msgs"))
    assert main(["stream", "--feed-dir", str(tmp_path / "feed"), "--messages-dir", str(tmp_path / "msgs"),
                 "--out", str(tmp_path / "out"), "--checkpoint", str(tmp_path / "ck"), "--once"]) == 0
    slots = spark.read.parquet(str(tmp_path / "out" / "slots"))
    assert slots.count() > 1000
    assert spark.read.parquet(str(tmp_path / "out" / "alerts")).select("metric").distinct().count() == 6


def test_maintained_jobs_on_the_command_line(spark, tmp_path, capsys):
    from feedlens.__main__ import main
    from feedlens.operators import audience, filters
    from feedlens.operators import experiment as ex
    feed, msgs = load_fixture(spark, SF001)
    feed.write.parquet(str(tmp_path / "feed"))
    msgs.write.parquet(str(tmp_path / "msgs"))
    both = ["--feed", str(tmp_path / "feed"), "--messages", str(tmp_path / "msgs")]
    for day in ("2024-01-09", "2024-01-10"):
        assert main(["user-counts", *both, "--run-date", day, "--table", "cli_users", "--location", str(tmp_path / "users")]) == 0
        assert main(["experiment", *both[:2], "--run-date", day, "--start", "2024-01-08", "--groups", "1", "2", "--table", "cli_exp",
                     "--location", str(tmp_path / "exp")]) == 0
        assert main(["app-report", *both, "--run-date", day, "--table", "cli_app", "--location", str(tmp_path / "app"), "--audience", "cli_weeks",
                     "--audience-location", str(tmp_path / "weeks")]) == 0
    said = capsys.readouterr().out.splitlines()
    users = filters.between_dates(feed, "2024-01-08", "2024-01-09").select("user_id").union(
        filters.between_dates(msgs, "2024-01-08", "2024-01-09").select("user_id")).distinct().count()
    assert f"2024-01-09 7 {users}" in said and f"2024-01-09 30 {users}" in said     # the tables hold two days
    stats = ex.welch_stats(ex.user_metrics(feed, (1, 2), "2024-01-08", "2024-01-09"), "ctr", 1, 2).first()
    mine = [x.split() for x in said if x.startswith("2024-01-09 ctr")][-1]
    assert [int(mine[2]), int(mine[3])] == [stats.n_a, stats.n_b] and abs(float(mine[4]) - stats.t) < 1e-9
    from feedlens.operators import audience_table
    kept = audience_table.weekly_audience_wide(spark.table("cli_weeks"), "2024-01-10").collect()
    assert kept == audience.weekly_audience_wide(feed, "2024-01-10").collect() and kept
