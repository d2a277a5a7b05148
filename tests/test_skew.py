"""A hot key holding a third of all rows: results stay exact (pandas brute force)."""

import datetime as dt
import random

import pandas as pd

from feedlens.operators import audience, cube, kpi
from feedlens.sources.schema import FEED_SCHEMA, MESSAGE_SCHEMA

DAY = dt.date(2024, 1, 8)


def _data(spark):
    rnd = random.Random(7)
    feed, msgs = [], []
    for i in range(6000):
        user = 1 if i % 3 == 0 else rnd.randint(2, 400)          # user 1: a third of the rows
        t = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rnd.randint(0, 14 * 24 * 60 - 1))
        feed.append((user, t, rnd.choice(["view", "view", "like"]), user % 4, rnd.randint(1, 900),
                     "iOS" if user % 3 else "Android", "ads" if user % 5 == 0 else "organic",
                     user % 2, 15 + user % 50))
        sender = 1 if i % 3 == 1 else rnd.randint(2, 400)
        receiver = 1 if i % 3 == 2 else rnd.randint(2, 400)      # and a third of the receipts
        msgs.append((sender, receiver, t))
    return (spark.createDataFrame(feed, FEED_SCHEMA), spark.createDataFrame(msgs, MESSAGE_SCHEMA),
            pd.DataFrame(feed, columns=FEED_SCHEMA.fieldNames()),
            pd.DataFrame(msgs, columns=MESSAGE_SCHEMA.fieldNames()))


def test_hot_key_results_are_exact(spark):
    feed, msgs, pf, pm = _data(spark)
    day_m = pm[pm.time.dt.date == DAY]
    sent = day_m.groupby("user_id").reciever_id.agg(["count", "nunique"])
    recv = day_m.groupby("reciever_id").user_id.agg(["count", "nunique"])
    got = {r.user_id: tuple(r)[1:] for r in cube.messages_by_user(msgs, DAY).collect()}
    want = {u: (int(s["count"]), int(s["nunique"]),
                int(recv["count"].get(u, 0)), int(recv["nunique"].get(u, 0)))
            for u, s in sent.iterrows()}
    assert got == want and got[1][0] > 100

    day_f = pf[pf.time.dt.date == DAY]
    assert kpi.active_users(feed, DAY).first().total == day_f.user_id.nunique()
    k = kpi.feed_kpis(feed, DAY).first()
    assert (k.views, k.likes) == ((day_f.action == "view").sum(), (day_f.action == "like").sum())

    weeks = pf.assign(w=pf.time.dt.to_period("W-SUN").dt.start_time.dt.date)[["user_id", "w"]]
    active = weeks.drop_duplicates()
    got = {(r.Date, r.status): r.num_users
           for r in audience.weekly_audience(feed, dt.date(2024, 1, 14)).collect()}
    w2 = dt.date(2024, 1, 8)
    a1 = set(active[active.w == dt.date(2024, 1, 1)].user_id)
    a2 = set(active[active.w == w2].user_id)
    assert got.get((w2, "retained"), 0) == len(a1 & a2) > 0
    assert got.get((w2, "new"), 0) == len(a2 - a1)
    assert got.get((w2, "gone"), 0) == -len(a1 - a2)

    c = cube.daily_cube(feed, msgs, DAY + dt.timedelta(days=1))
    totals = {}
    for r in c.collect():
        totals.setdefault(r.dimension, 0)
        totals[r.dimension] += r.views
    assert len(set(totals.values())) == 1
