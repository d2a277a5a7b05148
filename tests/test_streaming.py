import os
import shutil

from pyspark.sql import functions as F

from feedlens.operators import anomaly
from feedlens.sources.fixtures import feed_from_events, load_fixture, messages_from_events
from feedlens.streaming import start_slot_job

from fixture_paths import SF001


def test_stream_equals_batch_on_closed_slots_and_restart_is_idempotent(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    # two files -> two micro-batches (the second arrives after a restart)
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    ev.filter(F.col("ts") < "2024-01-15").coalesce(1).write.parquet(str(src / "part1"))
    ev.filter(F.col("ts") >= "2024-01-15").coalesce(1).write.parquet(str(src / "part2"))
    land = tmp_path / "landing"
    land.mkdir()
    for f in (src / "part1").glob("*.parquet"):
        shutil.copy(f, land / "a.parquet")
    schema = ev.schema

    def run():
        stream = spark.readStream.schema(schema).parquet(str(land))
        q = start_slot_job(spark, feed_from_events(spark, stream), messages_from_events(spark, stream),
                           str(tmp_path / "out"), checkpoint=str(tmp_path / "ckpt"))
        q.awaitTermination()
        assert q.exception() is None

    run()
    first = spark.read.parquet(str(tmp_path / "out" / "slots")).count()
    run()                                   # restart with no new data: nothing duplicated
    assert spark.read.parquet(str(tmp_path / "out" / "slots")).count() == first
    for f in (src / "part2").glob("*.parquet"):
        shutil.copy(f, land / "b.parquet")
    run()                                   # restart, new file: continues from the checkpoint
    got = spark.read.parquet(str(tmp_path / "out" / "slots")).drop("batch_id")
    feed, msgs = load_fixture(spark, SF001)
    batch = anomaly.finish_slots(anomaly.feed_slots(feed), anomaly.message_slots(msgs))
    max_t = min(df.agg(F.max("time")).first()[0] for df in (feed, msgs))
    # final = slot end + the 15-minute lateness allowance has passed in both sources
    closed = batch.filter(F.col("ts") + F.expr("INTERVAL 30 MINUTES") <= F.lit(max_t))
    assert got.count() == closed.count() > 1000
    assert got.select(closed.columns).exceptAll(closed).count() == 0
    alerts = spark.read.parquet(str(tmp_path / "out" / "alerts"))
    assert alerts.select("metric").distinct().count() == 6
    # every closed slot is scored once, as if all of them had been scored in one go
    want = anomaly.slot_alerts(anomaly.iqr_bounds(anomaly.unpivot_metrics(closed), 2.0, 6, "newest"))
    key = lambda df: sorted(map(str, (tuple(r) for r in df.select(*want.columns).collect())))
    assert key(alerts) == key(want)
    assert os.path.isdir(tmp_path / "ckpt")


def test_late_events_within_allowance_count_and_older_ones_are_dropped(spark, tmp_path):
    import datetime as dt

    from feedlens.sources.schema import FEED_SCHEMA, MESSAGE_SCHEMA

    def T(hm):
        return dt.datetime(2024, 1, 8, int(hm[:2]), int(hm[3:]))

    def feed_rows(items):
        return spark.createDataFrame(
            [(u, T(t), "view", 0, 1, "iOS", "ads", 1, 30) for u, t in items], FEED_SCHEMA)

    def msg_rows(items):
        return spark.createDataFrame([(u, 99, T(t)) for u, t in items], MESSAGE_SCHEMA)

    fdir, mdir = tmp_path / "feed", tmp_path / "msgs"
    first = [(1, "10:00"), (1, "10:20"), (1, "10:40"), (1, "10:46"), (1, "11:00")]
    feed_rows(first).write.parquet(str(fdir / "a"))
    msg_rows(first).write.parquet(str(mdir / "a"))

    def run():
        f = spark.readStream.schema(FEED_SCHEMA).parquet(str(fdir / "*"))
        m = spark.readStream.schema(MESSAGE_SCHEMA).parquet(str(mdir / "*"))
        q = start_slot_job(spark, f, m, str(tmp_path / "out"), checkpoint=str(tmp_path / "ckpt"))
        q.awaitTermination()
        assert q.exception() is None

    run()   # newest event 11:00 -> watermark 10:45: slots ending by 10:45 are final
    got = {r.hm: r.users_feed for r in spark.read.parquet(str(tmp_path / "out" / "slots")).collect()}
    assert got == {"10:00": 1, "10:15": 1, "10:30": 1}
    # late: 10:50 (slot 10:45 still open) counts; 10:05 (slot 10:00 already final) is dropped
    feed_rows([(2, "10:50"), (2, "10:05"), (1, "11:40")]).write.parquet(str(fdir / "b"))
    msg_rows([(2, "11:40")]).write.parquet(str(mdir / "b"))
    run()
    got = {r.hm: r.users_feed for r in spark.read.parquet(str(tmp_path / "out" / "slots")).collect()}
    assert got["10:00"] == 1 and got["10:45"] == 2
    assert "11:00" in got


def test_a_slower_source_holds_its_slots(spark, tmp_path):
    """Messages one batch behind the feed: no slot closes before its messages are in."""
    import datetime as dt

    from feedlens.sources.schema import FEED_SCHEMA, MESSAGE_SCHEMA
    start = dt.datetime(2024, 1, 8, 10)
    times = [start + dt.timedelta(minutes=5 * k) for k in range(48)]   # 16 slots, 10:00 to 13:45

    def run():
        f = spark.readStream.schema(FEED_SCHEMA).parquet(str(tmp_path / "feed" / "*"))
        m = spark.readStream.schema(MESSAGE_SCHEMA).parquet(str(tmp_path / "msgs" / "*"))
        q = start_slot_job(spark, f, m, str(tmp_path / "out"), checkpoint=str(tmp_path / "ckpt"))
        q.awaitTermination()
        assert q.exception() is None

    for k, part in enumerate((times[:24], times[24:], [start + dt.timedelta(hours=5)])):
        late = [[], times[:24], times[24:]][k]
        spark.createDataFrame([(1, t, "view", 0, 1, "iOS", "ads", 1, 30) for t in part], FEED_SCHEMA).write.parquet(str(tmp_path / "feed" / str(k)))
        spark.createDataFrame([(1, 2, t) for t in late], MESSAGE_SCHEMA).write.parquet(str(tmp_path / "msgs" / str(k)))
        run()
    slots = spark.read.parquet(str(tmp_path / "out" / "slots")).collect()
    assert len(slots) == 14 and {(r.views, r.sent_mess) for r in slots} == {(3, 3)}
    alerts = spark.read.parquet(str(tmp_path / "out" / "alerts"))
    assert alerts.select("ts").distinct().count() == 14 and alerts.count() == 14 * 6


def test_an_epoch_of_many_slots_scores_them_all(spark):
    from feedlens.streaming import score_slots
    feed, msgs = load_fixture(spark, SF001)
    slots = anomaly.finish_slots(anomaly.feed_slots(feed), anomaly.message_slots(msgs))
    full = anomaly.slot_alerts(anomaly.iqr_bounds(anomaly.unpivot_metrics(slots), 2.0, 6, "newest"))
    assert full.filter("is_alert").count() > 500

    def key(df):
        return sorted(map(str, (tuple(r) for r in df.collect())))

    cut = "ts < TIMESTAMP_NTZ'2024-01-15 00:00:00'"
    parts = score_slots(slots.filter(cut), slots.limit(0)).unionByName(score_slots(slots.filter(f"NOT {cut}"), slots.filter(cut)))
    assert key(parts) == key(full)


def test_undefined_values_are_flagged(spark):
    import datetime as dt
    rows = [(dt.datetime(2024, 1, 8, 10, 0) + dt.timedelta(minutes=15 * k), "CTR", None if k == 7 else 0.5) for k in range(8)]
    scored = anomaly.iqr_bounds(spark.createDataFrame(rows, "ts timestamp_ntz, metric string, value double"))
    got = anomaly.current_alerts(scored).first()
    assert got.undefined and not got.is_alert and got.text == "Undefined value of CTR"


def test_feed_rows_of_any_action_count_the_same_in_both_paths(make_feed, make_msgs):
    feed = make_feed([(1, "2024-01-08 10:00:00", "share", 0, 1, "iOS", "ads", 1, 30), (2, "2024-01-08 10:01:00", "view", 0, 1, "iOS", "ads", 1, 30)])
    msgs = make_msgs([(1, 2, "2024-01-08 10:02:00")])
    plain = anomaly.slot_metrics(feed, msgs, "2024-01-08 10:15:00").first()
    filled = anomaly.slot_metrics(feed, msgs, "2024-01-08 10:15:00", fill_gaps=True).filter("hm = '10:00' AND date = DATE'2024-01-08'").first()
    assert plain == filled and plain.users_feed == 2


def test_approximate_distinct_stream_is_close_to_exact(spark, tmp_path):
    from feedlens.streaming import stream_events
    ev = stream_events(spark, SF001)
    q = start_slot_job(spark, feed_from_events(spark, ev), messages_from_events(spark, ev),
                       str(tmp_path / "out"), checkpoint=str(tmp_path / "ck"), approx=True)
    q.awaitTermination()
    assert q.exception() is None
    got = {r.ts: r for r in spark.read.parquet(str(tmp_path / "out" / "slots")).collect()}
    feed, msgs = load_fixture(spark, SF001)
    exact = {r.ts: r for r in anomaly.finish_slots(anomaly.feed_slots(feed), anomaly.message_slots(msgs)).collect()}
    assert set(got) <= set(exact) and len(got) > 1000
    for ts, r in got.items():
        e = exact[ts]
        assert (r.views, r.likes, r.sent_mess) == (e.views, e.likes, e.sent_mess)
        assert abs(r.users_feed - e.users_feed) <= max(1, 0.05 * e.users_feed)
        assert abs(r.users_mess - e.users_mess) <= max(1, 0.05 * e.users_mess)


def test_epochs_score_from_the_state_and_read_no_earlier_output(spark, tmp_path):
    """Each run writes into a folder of its own, so what earlier epochs wrote is out of reach:
    the bounds come from the checkpoint's state alone."""
    feed, msgs = load_fixture(spark, SF001)
    src = {"feed": feed.select("user_id", "time", "action"), "msgs": msgs.select("user_id", "time")}
    cuts = ["2024-01-01", "2024-01-06", "2024-01-06 05:00:00", "2024-01-20", "2024-02-01"]
    parts = []
    for k, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        for kind, df in src.items():
            df.filter((F.col("time") >= lo) & (F.col("time") < hi)).coalesce(1).write.parquet(str(tmp_path / kind / str(k)))
        streams = [spark.readStream.schema(df.schema).parquet(str(tmp_path / kind / "*")) for kind, df in src.items()]
        out = str(tmp_path / f"out{k}")
        q = start_slot_job(spark, *streams, out, checkpoint=str(tmp_path / "ck"))
        q.awaitTermination()
        assert q.exception() is None
        parts.append(spark.read.parquet(f"{out}/alerts"))
    batch = anomaly.finish_slots(anomaly.feed_slots(feed), anomaly.message_slots(msgs))
    newest = min(df.agg(F.max("time")).first()[0] for df in (feed, msgs))
    closed = batch.filter(F.col("ts") + F.expr("INTERVAL 30 MINUTES") <= F.lit(newest))
    want = anomaly.slot_alerts(anomaly.iqr_bounds(anomaly.unpivot_metrics(closed), 2.0, 6, "newest"))
    got = [str(tuple(r)) for p in parts for r in p.select(*want.columns).collect()]
    assert sorted(got) == sorted(str(tuple(r)) for r in want.collect())
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")
