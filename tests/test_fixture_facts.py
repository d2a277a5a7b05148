"""The fixture facts listed in FIXTURES.md §3 (sf0.01), recomputed with the operators."""

import datetime as dt

from pyspark.sql import functions as F

from feedlens.operators import anomaly, audience, cube, kpi
from feedlens.operators import experiment as ex
from feedlens.operators.filters import between_dates, on_day
from feedlens.sources.fixtures import load_fixture

from fixture_paths import SF001

D8 = dt.date(2024, 1, 8)


def test_fixture_facts(spark):
    feed, msgs = load_fixture(spark, SF001)
    assert (feed.count(), msgs.count()) == (4204, 3995)
    um = ex.user_metrics(feed, (0, 1, 2, 3, 4), "2024-01-08", "2024-01-14")
    assert {r.exp_group: r["count"] for r in um.groupBy("exp_group").count().collect()} == \
        {g: 21 for g in range(5)}
    day = ex.user_metrics(feed, (0, 1, 2, 3, 4), D8, D8)
    assert day.filter((F.col("likes") > 0) & (F.col("views") == 0)).count() == 17
    assert kpi.new_users(feed, D8).first().new_users == 31
    s = kpi.new_users_by_source(feed, D8).first()
    assert (s.ads, s.organic) == (3, 29)
    assert kpi.new_posts(feed, D8).first().new_posts == 24
    wk = {r.status: r.num_users for r in audience.weekly_audience(feed, "2024-01-30").collect()
          if r.Date == D8}
    assert (wk["new"], wk["retained"], wk["gone"]) == (45, 60, -45)
    fu = cube.feed_by_user(feed, D8)
    senders = on_day(msgs, D8).select("user_id").distinct()
    joined = fu.join(senders, "user_id")
    assert (joined.count(), joined.select("user_id").distinct().count()) == (49, 46)
    merged = cube.merged_by_user(feed, msgs, D8)
    assert merged.filter(F.col("messages_received") == 0).count() == 26
    assert on_day(feed, D8).filter(F.col("age") == 31).select("user_id").distinct().count() == 3
    two_days = anomaly.finish_slots(anomaly.feed_slots(between_dates(feed, D8, D8 + dt.timedelta(days=1))),
                                    anomaly.message_slots(between_dates(msgs, D8, D8 + dt.timedelta(days=1))))
    assert two_days.count() == 114
