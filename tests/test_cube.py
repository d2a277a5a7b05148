import datetime as dt

from pyspark.sql import functions as F

from feedlens.operators import cube
from feedlens.sources.sinks import ensure_cube_table, write_cube

D8 = "2024-01-08"
FEED = [
    # user 1 appears with two os values on the same day (Q3)
    (1, "2024-01-08 10:00:00", "view", 1, 1, "iOS", "ads", 1, 31),
    (1, "2024-01-08 11:00:00", "like", 1, 1, "Android", "ads", 1, 31),
    (2, "2024-01-08 11:00:00", "view", 2, 2, "Android", "organic", 0, 20),
    (2, "2024-01-08 12:00:00", "view", 2, 2, "Android", "organic", 0, 20),
    (3, "2024-01-08 12:00:00", "view", 2, 3, "iOS", "organic", None, None),
    (5, "2024-01-08 12:00:00", "view", 2, 3, "iOS", "organic", 1, 45),   # sends nothing
]
MSGS = [
    (1, 2, "2024-01-08 10:00:00"), (1, 2, "2024-01-08 10:01:00"), (1, 3, "2024-01-08 10:02:00"),
    (2, 1, "2024-01-08 10:03:00"),
    (3, 9, "2024-01-08 10:04:00"),          # 3 sends, receives nothing -> zeros (D5)
    (7, 1, "2024-01-08 10:05:00"),          # 7 sends, no feed activity -> not in cube
    (8, 8, "2024-01-07 10:05:00"),          # other day
]


def test_messages_by_user(make_msgs):
    got = {r.user_id: tuple(r)[1:] for r in cube.messages_by_user(make_msgs(MSGS), D8).collect()}
    assert got == {1: (3, 2, 2, 2), 2: (1, 1, 2, 1), 3: (1, 1, 1, 1), 7: (1, 1, 0, 0)}


def test_feed_by_user_groups_by_labels(make_feed):
    rows = cube.feed_by_user(make_feed(FEED), D8, "reference").collect()
    by = {(r.user_id, r.os): r for r in rows}
    assert len(rows) == 5
    assert by[(1, "iOS")].age_group == "41+"              # age 31 falls through (Q1)
    assert by[(3, "iOS")].gender_label == "female" and by[(3, "iOS")].age_group == "41+"  # NULLs (D6)
    assert by[(2, "Android")].views == 2 and by[(2, "Android")].age_group == "0 - 20"
    fixed = {(r.user_id, r.os): r for r in cube.feed_by_user(make_feed(FEED), D8, "fixed").collect()}
    assert fixed[(1, "iOS")].age_group == "31-40"


def _cube(df):
    return {(r.dimension, r.dimension_value): tuple(r)[3:] for r in df.collect()}


def test_daily_cube_default_repeats_messages(make_feed, make_msgs):
    c = _cube(cube.daily_cube(make_feed(FEED), make_msgs(MSGS), "2024-01-09", "reference"))
    # user 1 has two os rows; its message counters appear in both os values
    assert c[("os", "iOS")] == (1 + 1, 0, 3 + 1, 2 + 1, 2 + 1, 2 + 1)
    assert c[("os", "Android")] == (0 + 2, 1, 3 + 1, 2 + 1, 2 + 2, 2 + 1)
    # and twice in 'male' (Q3 over-count, as the source job does)
    assert c[("gender", "male")] == (1, 1, 6, 4, 4, 4)
    totals = {}
    for (dim, _), vals in c.items():
        totals.setdefault(dim, [0] * 6)
        totals[dim] = [a + b for a, b in zip(totals[dim], vals)]
    assert totals["os"] == totals["gender"] == totals["age"]


def test_daily_cube_dedupe_counts_each_user_once(make_feed, make_msgs):
    c = _cube(cube.daily_cube(make_feed(FEED), make_msgs(MSGS), "2024-01-09", "reference",
                              dedupe_messages=True))
    assert c[("gender", "male")] == (1, 1, 3, 2, 2, 2)
    assert c[("os", "iOS")] == (2, 0, 4, 3, 3, 3)


def test_cube_write_is_idempotent_per_day(spark, make_feed, make_msgs, tmp_path):
    name = "cube_idem"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    ensure_cube_table(spark, name, str(tmp_path / "cube"))
    ensure_cube_table(spark, name, str(tmp_path / "cube"))   # IF NOT EXISTS
    feed, msgs = make_feed(FEED), make_msgs(MSGS)
    day1 = cube.daily_cube(feed, msgs, "2024-01-09")
    other = day1.withColumn("event_date", F.lit(dt.date(2024, 1, 7)))
    write_cube(other, name, "2024-01-07")
    write_cube(day1, name, "2024-01-08")
    write_cube(day1, name, "2024-01-08")                      # rerun of the same day
    counts = {r[0]: r[1] for r in spark.table(name).groupBy("event_date").count().collect()}
    n = day1.count()
    assert counts == {dt.date(2024, 1, 7): n, dt.date(2024, 1, 8): n}
    write_cube(day1.limit(0), name, "2024-01-08")             # a rerun whose feed is now empty
    assert [r[0] for r in spark.table(name).select("event_date").distinct().collect()] == [dt.date(2024, 1, 7)]
    spark.sql(f"DROP TABLE IF EXISTS {name}")
