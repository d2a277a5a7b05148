"""Maintained tables against the same figures from all events."""

import datetime as dt
import os
import random
import shutil
import uuid

import pytest
from pyspark.sql import functions as F

from feedlens.operators import audience, audience_table, cube, distinct, filters, first_seen, kpi, seen_filter, sketches, user_days
from feedlens.operators import experiment as ex
from feedlens.operators.experiment import daily, sketched
from feedlens.sources.fixtures import load_fixture
from feedlens.sources.schema import FEED_SCHEMA, MESSAGE_SCHEMA
from feedlens.streaming import event_table, start_ingest_job

from fixture_paths import SF001

D = dt.date
ONE = dt.timedelta(days=1)


def name(kind):
    return f"t_{kind}_{uuid.uuid4().hex[:10]}"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def files(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet")}


# ------------------------------------------------------------------ bitmaps
@pytest.fixture(scope="module")
def bitmaps(spark, tmp_path_factory):
    feed, msgs = load_fixture(spark, SF001)
    prefix, path = name("bits"), str(tmp_path_factory.mktemp("bits"))
    distinct.ensure_user_bitmaps(spark, prefix, path)
    distinct.backfill_user_bitmaps(feed, msgs, prefix, "2024-01-01", "2024-01-26")
    for d in ("2024-01-28", "2024-01-27", "2024-01-29", "2024-01-27", "2024-01-30"):   # out of order, one twice
        distinct.update_user_bitmaps(feed, msgs, prefix, d)
    return feed, msgs, prefix, path


@pytest.mark.parametrize("days", [1, 7, 14, 30])
def test_bitmaps_equal_count_distinct(spark, bitmaps, days):
    feed, msgs, prefix, _ = bitmaps
    table, hi = spark.table(f"{prefix}_days"), D(2024, 1, 30)
    lo = hi - (days - 1) * ONE
    in_feed = filters.between_dates(feed, lo, hi).select("user_id")
    either = in_feed.union(filters.between_dates(msgs, lo, hi).select("user_id"))
    for services, want in ((["feed"], in_feed), (None, either)):
        assert distinct.distinct_users(table, lo, hi, services).first().users == want.agg(F.count_distinct("user_id")).first()[0] > 0
    rolled = distinct.rolling_users(table, hi, hi, (days,), ["feed"]).collect()
    assert [tuple(r) for r in rolled] == [(hi, days, in_feed.agg(F.count_distinct("user_id")).first()[0])]


def test_bitmaps_read_day_partitions_only(spark, bitmaps):
    _, _, prefix, _ = bitmaps
    df = distinct.distinct_users(spark.table(f"{prefix}_days"), "2024-01-24", "2024-01-30")
    assert "PartitionFilters: [isnotnull(event_date" in plan(df) and "user_id" not in plan(df)
    assert len(df.select("users").inputFiles()) == len(
        [f for f in spark.table(f"{prefix}_days").inputFiles() if "event_date=2024-01-2" in f and f.split("event_date=2024-01-")[1][:2] >= "24" or "01-30" in f])


def test_numbers_are_dense_stable_and_unique(spark, bitmaps):
    feed, msgs, prefix, path = bitmaps
    index = spark.table(f"{prefix}_index")
    parts = index.groupBy("part").agg(F.count("*").alias("n"), F.max("number").alias("top"), F.count_distinct("user_id").alias("u"),
                                      F.count_distinct("number").alias("d")).collect()
    assert all(r.n == r.top == r.u == r.d for r in parts)
    before, other = rows(index), files(f"{path}/days/event_date=2024-01-20")
    distinct.update_user_bitmaps(feed, msgs, prefix, "2024-01-30")
    assert rows(spark.table(f"{prefix}_index")) == before and files(f"{path}/days/event_date=2024-01-20") == other


def test_empty_range_and_null_users(spark, make_feed, make_msgs, tmp_path):
    prefix = name("bits")
    distinct.ensure_user_bitmaps(spark, prefix, str(tmp_path))
    feed = make_feed([(None, "2024-01-08 10:00:00", "view", 0, 1, "iOS", "ads", 1, 30), (7, "2024-01-08 10:00:00", "view", 0, 1, "iOS", "ads", 1, 30)])
    distinct.update_user_bitmaps(feed, make_msgs([]), prefix, "2024-01-08")
    table = spark.table(f"{prefix}_days")
    assert distinct.distinct_users(table, "2024-01-08", "2024-01-08").first().users == 1
    assert distinct.distinct_users(table, "2024-01-09", "2024-01-19").first().users == 0


# ------------------------------------------------------------------ sketches
def test_sketches_merge_within_their_error(spark, tmp_path):
    start = dt.datetime(2024, 1, 8)
    feed = spark.range(400_000).select((F.col("id") % 90_000).alias("user_id"), (F.lit(start) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id") % 172_800))
                                       .cast("timestamp_ntz").alias("time"), F.lit("view").alias("action"))
    msgs = spark.range(50_000).select((F.col("id") + 60_000).alias("user_id"), F.lit(start).cast("timestamp_ntz").alias("time"))
    table = name("hll")
    sketches.ensure_hourly_sketches(spark, table, str(tmp_path / table))
    sketches.backfill_hourly_sketches(feed, msgs, table, "2024-01-08", "2024-01-08")
    sketches.update_hourly_sketches(feed, msgs, table, "2024-01-09")
    sketches.update_hourly_sketches(feed, msgs, table, "2024-01-09")
    stored = spark.table(table)
    both = feed.select("user_id", "time").union(msgs)
    error = 3 * 1.04 / 2 ** (kpi.SKETCH_LOG2 / 2)
    for lo, hi in (("2024-01-08", "2024-01-08"), ("2024-01-08", "2024-01-09")):
        want = filters.between_dates(both, lo, hi).agg(F.count_distinct("user_id")).first()[0]
        got = sketches.merged_users(stored, lo, hi).first().users
        assert abs(got - want) <= error * want and want > 50_000
    for r in sketches.users_by_grain(stored, "2024-01-08", "2024-01-09").collect():
        if r.service == "message":
            assert abs(r.users - 50_000) <= error * 50_000
    assert stored.filter("event_date = DATE'2024-01-09'").count() == 24
    assert "PartitionFilters: [isnotnull(event_date" in plan(sketches.merged_users(stored, "2024-01-08", "2024-01-08", "service"))


def test_few_users_are_counted_one_by_one(spark):
    for n in (1, 30, 1000):
        df = spark.range(n).select(F.col("id").alias("user_id"))
        assert df.agg(kpi._distinct_users(approx=True)).first()[0] == n


# ------------------------------------------------------------------ audience
def test_audience_table_equals_the_scan_after_out_of_order_days(spark, tmp_path):
    rng, table = random.Random(5), name("weeks")
    # 62-week spans of the table end in the middle of these days
    end = audience_table.FIRST_MONDAY + dt.timedelta(weeks=62 * 45)
    days = [end + dt.timedelta(days=k) for k in range(-25, 20)]
    data = [(rng.choice([1, 2, 3, 4, 5, 6, 7, None]), dt.datetime.combine(rng.choice(days), dt.time(12)), "view", 0, 1, "iOS", "ads", 1, 30) for _ in range(90)]
    feed = spark.createDataFrame(data, FEED_SCHEMA)
    audience_table.ensure_audience_table(spark, table, str(tmp_path / table))
    order = days[:]
    rng.shuffle(order)
    audience_table.update_audience(feed, table, days[0], days[20])
    for d in order[::3] + [d for d in days if d > days[20]] + order[:3]:
        audience_table.update_audience(feed, table, d)
    stored = spark.table(table)
    assert {r.span for r in stored.select("span").distinct().collect()} == {44, 45}
    run = days[-1]
    assert rows(audience_table.weekly_audience(stored, run)) == rows(audience.weekly_audience(feed, run))
    assert rows(audience_table.weekly_audience_wide(stored, run)) == rows(audience.weekly_audience_wide(feed, run))
    for since in (days[3], days[25], days[40]):
        assert rows(audience_table.weekly_audience(stored, run, since)) == rows(audience.weekly_audience(feed, run, since))


def test_audience_report_shuffles_no_users(spark, tmp_path):
    table = name("weeks")
    audience_table.ensure_audience_table(spark, table, str(tmp_path / table))
    feed, _ = load_fixture(spark, SF001)
    audience_table.update_audience(feed, table, "2024-01-01", "2024-01-15")
    old = files(tmp_path / table)
    p = plan(audience_table.user_week_statuses(spark.table(table), "2024-01-15").groupBy("week", "status").count())
    assert "Join" not in p and "user_id" not in p.split("ReadSchema")[1]
    audience_table.update_audience(feed, table, "2024-01-16")
    assert old and rows(audience_table.weekly_audience(spark.table(table), "2024-01-16")) == rows(audience.weekly_audience(feed, "2024-01-16"))


# ------------------------------------------------------------------ late events
def event(kind, u, t):
    t = dt.datetime.fromisoformat(t)
    return (u, t, "view", 0, 1, "iOS", "ads", 1, 30) if kind == "feed" else (u, u + 1, t)


def test_late_events_correct_their_day_and_replays_change_nothing(spark, tmp_path):
    table = name("cube")
    arrivals = {"feed": [], "messages": []}

    def arrive(k, items):
        for kind, schema in (("feed", FEED_SCHEMA), ("messages", MESSAGE_SCHEMA)):
            new = [event(kind, u, t) for u, t in items]
            arrivals[kind] += new
            spark.createDataFrame(new, schema).coalesce(1).write.parquet(str(tmp_path / "in" / kind / str(k)))

    def run():
        streams = [spark.readStream.schema(s).parquet(str(tmp_path / "in" / kind / "*")) for kind, s in (("feed", FEED_SCHEMA), ("messages", MESSAGE_SCHEMA))]
        q = start_ingest_job(spark, *streams, str(tmp_path / "events"), table, str(tmp_path / "ck"), str(tmp_path / "cube"))
        q.awaitTermination()
        assert q.exception() is None

    def check():
        full = [spark.createDataFrame(arrivals[k], s) for k, s in (("feed", FEED_SCHEMA), ("messages", MESSAGE_SCHEMA))]
        days = sorted({r[1].date() if len(r) > 3 else r[2].date() for r in arrivals["feed"] + arrivals["messages"]})
        want = cube.daily_cube(*full, days[0] + ONE)
        for d in days[1:]:
            want = want.unionByName(cube.daily_cube(*full, d + ONE))
        assert rows(spark.table(table).select(want.columns)) == rows(want)

    arrive(0, [(1, "2024-01-06 10:00:00"), (2, "2024-01-06 11:00:00"), (1, "2024-01-07 10:00:00"), (3, "2024-01-08 09:00:00")])
    run()
    check()
    untouched = files(tmp_path / "cube" / "event_date=2024-01-07")
    arrive(1, [(4, "2024-01-06 12:00:00"), (1, "2024-01-06 13:00:00"), (5, "2024-01-09 08:00:00")])     # two days late
    run()
    check()
    assert untouched and files(tmp_path / "cube" / "event_date=2024-01-07") == untouched
    for _ in range(2):      # the epoch's commit is lost: it is replayed
        last = max(int(f) for f in os.listdir(tmp_path / "ck" / "commits") if f.isdigit())
        for f in (f"{last}", f".{last}.crc"):
            if os.path.exists(tmp_path / "ck" / "commits" / f):
                shutil.move(str(tmp_path / "ck" / "commits" / f), str(tmp_path / f"lost-{uuid.uuid4().hex}"))
        run()
        check()
    assert event_table(spark, str(tmp_path / "events"), "feed").count() == len(arrivals["feed"])
    assert files(tmp_path / "cube" / "event_date=2024-01-07") == untouched


# ------------------------------------------------------------------ co-located day tables
def test_bucketed_join_has_no_exchange(spark, tmp_path):
    feed, msgs = load_fixture(spark, SF001)
    prefix = name("days")
    user_days.ensure_user_days(spark, prefix, str(tmp_path / prefix), buckets=4)
    for d in ("2024-01-07", "2024-01-08", "2024-01-08"):
        user_days.write_user_days(feed, msgs, prefix, d, buckets=4)
    joined = user_days.merged_user_day(spark, prefix, "2024-01-08")
    assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
    for dedupe in (False, True):
        assert rows(user_days.cube_from_user_days(spark, prefix, "2024-01-08", dedupe)) == rows(cube.daily_cube(feed, msgs, "2024-01-09", dedupe_messages=dedupe))
    per_bucket = [f for f in os.listdir(tmp_path / prefix / "feed" / "event_date=2024-01-08") if f.endswith(".parquet")]
    assert len(per_bucket) == 4


# ------------------------------------------------------------------ experiments by day
def test_experiment_by_day_equals_the_full_recomputation(spark, tmp_path):
    feed, _ = load_fixture(spark, SF001)
    prefix, lo, hi = name("exp"), D(2024, 1, 8), D(2024, 1, 14)
    daily.ensure_experiment_tables(spark, prefix, str(tmp_path / prefix))
    days = [lo + k * ONE for k in range(7)]
    for d in days + [days[-1]]:
        daily.update_experiment(feed, prefix, (1, 2), lo, d)
    got = {(r.Date, r.metric): r for r in daily.welch_running(spark.table(f"{prefix}_moments"), lo, hi, 1, 2).collect()}
    assert len(got) == 14
    for d in days:
        um = ex.user_metrics(feed, (1, 2), lo, d)
        for metric, df in (("ctr", um), ("linearized_likes", ex.linearized_likes(um, (1, 2), 1))):
            want = ex.welch_stats(df, metric, 1, 2).first()
            for f in ("n_a", "n_b", "mean_a", "mean_b", "var_a", "var_b", "t", "df"):
                assert getattr(got[d, metric], f) == pytest.approx(getattr(want, f), rel=1e-9, abs=1e-12), (d, metric, f)
    update = daily.running_sums(feed, spark.table(f"{prefix}_users"), (1, 2), lo, hi)
    assert "2024-01-14 00:00:00" in plan(update) and "2024-01-08 00:00:00" not in plan(update)


def test_experiment_quiet_days_new_users_and_no_views(spark, make_feed, tmp_path):
    prefix = name("exp")
    daily.ensure_experiment_tables(spark, prefix, str(tmp_path / prefix))
    f = lambda u, t, a, g: (u, t, a, g, 1, "iOS", "ads", 1, 30)
    feed = make_feed([f(1, "2024-01-08 10:00:00", "like", 1), f(2, "2024-01-08 10:00:00", "view", 2), f(3, "2024-01-08 11:00:00", "view", 1),
                      f(1, "2024-01-10 10:00:00", "view", 1), f(None, "2024-01-10 10:00:00", "view", 2), f(4, "2024-01-10 12:00:00", "like", 2)])
    for d in ("2024-01-08", "2024-01-09", "2024-01-10"):
        daily.update_experiment(feed, prefix, (1, 2), "2024-01-08", d)
    got = {(str(r.Date), r.metric): r for r in daily.welch_running(spark.table(f"{prefix}_moments"), "2024-01-08", "2024-01-10", 1, 2).collect()}
    for d in ("2024-01-08", "2024-01-09", "2024-01-10"):
        want = ex.welch_stats(ex.user_metrics(feed, (1, 2), "2024-01-08", d), "ctr", 1, 2).first()
        r = got[d, "ctr"]
        assert (r.n_a, r.n_b, r.n_undefined, r.mean_a, r.mean_b) == (want.n_a, want.n_b, want.n_undefined, want.mean_a, want.mean_b)


# ------------------------------------------------------------------ quantile sketches
@pytest.mark.parametrize("margin", [0.01, 0.0])
def test_sketched_quantile_equals_the_exact_one(spark, margin):
    df = spark.range(60_000).select((F.col("id") % 3).cast("int").alias("g"), F.when(F.col("id") % 101 != 0, F.pmod(F.xxhash64("id"), F.lit(50_000)) - 20_000).alias("v"))
    few = spark.createDataFrame([(7, 5), (7, 5), (8, None), (9, 1), (9, 2), (9, 3)], "g int, v bigint")
    df = df.unionByName(few)
    for q in (0.0, 0.25, 0.9, 1.0):
        got = sketched.sketched_quantile(df, ["g"], "v", q, margin=margin)
        assert rows(got) == rows(ex.index_quantile(df, ["g"], "v", q))


def test_values_outside_the_bracket_are_not_shuffled(spark):
    df = spark.range(100_000).select((F.col("id") % 2).alias("g"), (F.col("id") * 7919 % 100_003).alias("v"))
    bounds = sketched.brackets(sketched.value_sketches(df, ["g"], "v"), ["g"], 0.5)
    left = sketched.inside_brackets(df, bounds, ["g"], "v")
    assert 500 < left.count() < 4_000
    stored = sketched.value_sketches(df.withColumn("day", F.col("id") if "id" in df.columns else F.col("v") % 5), ["g", "day"], "v")
    merged = sketched.merged_sketches(stored, ["g"])
    assert rows(sketched.sketched_quantile(df, ["g"], "v", 0.5, sketches=merged)) == rows(ex.index_quantile(df, ["g"], "v", 0.5))


# ------------------------------------------------------------------ first seen by filter
def test_filtered_first_seen_equals_the_scan(spark, tmp_path):
    feed, _ = load_fixture(spark, SF001)
    table, keys = name("seen"), ["user_id", "source"]
    first_seen.ensure_first_seen_table(spark, table, keys, {"user_id": "BIGINT", "source": "STRING"}, str(tmp_path / "t"))
    seen_filter.ensure_filter_table(spark, f"{table}_f", str(tmp_path / "f"))
    seen_filter.backfill(feed, table, f"{table}_f", "2024-01-05", 5_000)
    for d in (6, 7, 8, 8):
        seen_filter.update(feed, table, f"{table}_f", D(2024, 1, d), D(2024, 1, d) - ONE, 5_000)
    want = (filters.up_to_day(feed, "2024-01-08").dropna(subset=keys).groupBy(*keys).agg(F.min(F.to_date("time")).alias("first_date")))
    assert rows(spark.table(table).select(*keys, "first_date")) == rows(want)


def test_filter_decides_nearly_all_new_keys(spark):
    seen = spark.range(20_000).select(F.col("id").alias("k"))
    asked = spark.range(15_000, 45_000).select(F.col("id").alias("k")).union(spark.range(15_000, 16_000).select("id"))
    bits = seen_filter.key_bits(seen, ["k"], 20_000)
    maybe = {r.k for r in seen_filter.maybe_seen(asked, bits, ["k"], 20_000).collect()}
    assert set(range(15_000, 20_000)) <= maybe                       # none is lost
    assert len(maybe) - 5_000 <= 0.012 * 25_000                      # few are looked up for nothing
    assert seen_filter.maybe_seen(asked, bits.limit(0), ["k"], 20_000).count() == 0
