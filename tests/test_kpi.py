import datetime as dt

from feedlens.operators import kpi
from feedlens.plans import reports

D8 = dt.date(2024, 1, 8)

ROWS = [
    # user, time, action, group, post, os, source, gender, age
    (1, "2024-01-07 10:00:00", "view", 1, 100, "iOS", "ads", 1, 25),
    (1, "2024-01-08 10:00:00", "view", 1, 101, "iOS", "ads", 1, 25),
    (1, "2024-01-08 10:30:00", "like", 1, 101, "iOS", "ads", 1, 25),
    (2, "2024-01-08 11:00:00", "view", 2, 102, "Android", "organic", 0, 35),
    (2, "2024-01-08 23:59:59", "view", 2, 102, "Android", "ads", 0, 35),
    (3, "2024-01-08 12:00:00", "like", 3, 103, "iOS", "organic", 1, 50),
    (3, "2024-01-09 00:00:00", "view", 3, 104, "iOS", "organic", 1, 50),
]


def test_feed_kpis_day_and_range(make_feed):
    feed = make_feed(ROWS)
    r = kpi.feed_kpis(feed, D8).collect()
    assert len(r) == 1
    r = r[0]
    assert (r.Date, r.views, r.likes, r.DAU) == (D8, 3, 2, 3)
    assert abs(r.CTR - 2 / 3) < 1e-12
    week = {x.Date: x for x in kpi.feed_kpis(feed, "2024-01-03", "2024-01-09").collect()}
    assert sorted(week) == [dt.date(2024, 1, 7), D8, dt.date(2024, 1, 9)]
    assert week[dt.date(2024, 1, 9)].likes == 0 and week[dt.date(2024, 1, 9)].CTR == 0.0


def test_day_without_data_still_gives_one_row(make_feed):
    feed = make_feed(ROWS)
    empty = dt.date(2024, 2, 1)
    assert kpi.active_users(feed, empty).collect()[0].total == 0
    assert kpi.new_users(feed, empty).collect()[0].new_users == 0
    src = kpi.new_users_by_source(feed, empty).collect()[0]
    assert (src.ads, src.organic) == (0, 0)
    t = kpi.feed_day_totals(feed, empty).collect()[0]
    assert (t.views, t.likes, t.CTR, t.DAU) == (0, 0, None, 0)
    rep = reports.feed_report(feed, empty + dt.timedelta(days=1)).collect()[0]
    assert rep.text == "Feed summary for 2024-02-01: views 0, likes 0, CTR n/a%, DAU 0"


def test_first_seen_semantics(make_feed):
    feed = make_feed(ROWS)
    # user 1 was seen on the 7th; users 2 and 3 are new on the 8th
    assert kpi.new_users(feed, D8).collect()[0].new_users == 2
    # (user, source) pairs first seen on the 8th: (1, ads) no; (2, organic), (2, ads), (3, organic)
    s = kpi.new_users_by_source(feed, D8).collect()[0]
    assert (s.ads, s.organic) == (1, 2)
    # posts first seen on the 8th: 101, 102, 103 (100 on the 7th, 104 on the 9th)
    assert kpi.new_posts(feed, D8).collect()[0].new_posts == 3
    assert kpi.active_users(feed, D8).collect()[0].total == 3


def test_avg_activity_and_hourly(make_feed, make_msgs):
    feed = make_feed(ROWS)
    avg = {r.Date: r for r in kpi.avg_activity(feed, "2024-01-09", 14).collect()}
    assert sorted(avg) == [dt.date(2024, 1, 7), D8]          # the 9th is "today", excluded
    assert avg[D8].avg_views == 1.0 and abs(avg[D8].avg_likes - 2 / 3) < 1e-12
    msgs = make_msgs([(1, 2, "2024-01-08 10:05:00"), (1, 3, "2024-01-08 10:50:00"),
                      (4, 1, "2024-01-08 23:00:00")])
    rows = [(r.hour.hour, r.users, r.service) for r in kpi.hourly_users(feed, msgs, D8).collect() if r.hour.date() == D8]
    assert rows == [(10, 1, "feed"), (11, 1, "feed"), (12, 1, "feed"), (23, 1, "feed"),
                    (10, 1, "message"), (23, 1, "message")]


def test_report_texts(make_feed):
    feed = make_feed(ROWS)
    f = reports.feed_report(feed, "2024-01-09").collect()[0]
    assert f.text == "Feed summary for 2024-01-08: views 3, likes 2, CTR 67%, DAU 3"
    a = reports.app_report(feed, "2024-01-09").collect()[0]
    assert a.text == ("App summary for 2024-01-08: active users 3, new users 2 (ads 1, organic 2), "
                      "new posts 3")


def test_first_seen_counts_equal_the_separate_operators(spark):
    from feedlens.sources.fixtures import load_fixture
    from fixture_paths import SF001
    feed, _ = load_fixture(spark, SF001)
    for day in (dt.date(2024, 1, 2), D8, dt.date(2024, 1, 20)):
        got = kpi.first_seen_counts(feed, day).first()
        s = kpi.new_users_by_source(feed, day).first()
        assert (got.new_users, got.ads, got.organic, got.new_posts) == (
            kpi.new_users(feed, day).first().new_users, s.ads, s.organic,
            kpi.new_posts(feed, day).first().new_posts)


def test_percent_rounds_half_to_even_and_null_users_are_no_users(make_feed):
    feed = make_feed([(1, "2024-01-08 10:00:00", "view", 0, 1, "iOS", "ads", 1, 30)] * 8 + [(1, "2024-01-08 10:00:00", "like", 0, 1, "iOS", "ads", 1, 30)])
    assert "CTR 12%" in reports.feed_report(feed, "2024-01-09").first().text      # 12.5
    feed = make_feed([(None, "2024-01-08 10:00:00", "view", 0, 1, "iOS", "ads", 1, 30), (2, "2024-01-08 10:00:00", "view", 0, 1, "iOS", "ads", 1, 30)])
    assert kpi.new_users_by_source(feed, D8).first().ads == kpi.first_seen_counts(feed, D8).first().ads == 1
