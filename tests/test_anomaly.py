import datetime as dt
import math

import numpy as np

from feedlens.operators import anomaly

T0 = dt.datetime(2024, 1, 8)


def _long(spark, series: dict[str, list]):
    rows = [(T0 + dt.timedelta(minutes=15 * i), m, None if v is None else float(v))
            for m, vals in series.items() for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, "ts timestamp_ntz, metric string, value double")


def _pandas_bounds(vals, a=2, n=6):
    """The bounds from their definition: quartiles of the n values before, then the mean of
    the bounds that exist from n//2 places before to (n-1)//2 places after."""
    nan = float("nan")
    raw = []
    for i in range(len(vals)):
        seen = vals[max(0, i - n):i]
        if len(seen) < n or None in seen:
            raw.append((nan, nan))
        else:
            low, high = np.quantile(seen, [0.25, 0.75])
            raw.append((high + a * (high - low), low - a * (high - low)))

    def smooth(side):
        out = []
        for i in range(len(vals)):
            near = [r[side] for r in raw[max(0, i - n // 2):i + (n - 1) // 2 + 1] if not math.isnan(r[side])]
            out.append(sum(near) / len(near) if near else nan)
        return out

    return smooth(0), smooth(1)


SERIES = {
    "views": [10, 12, 11, 13, 12, 14, 13, 15, 40, 14, 13, 12, 11, 12, 13, 3],
    "CTR": [0.2, 0.21, None, 0.19, 0.2, 0.22, 0.2, 0.21, 0.2, 0.23, 0.19, 0.2, 0.9, 0.2],
}


def _close(a, b):
    if a is None or (isinstance(a, float) and math.isnan(a)):
        return b is None or (isinstance(b, float) and math.isnan(b))
    return b is not None and not math.isnan(b) and abs(a - b) < 1e-9


def test_centred_bounds_equal_pandas(spark):
    got = _long(spark, SERIES)
    scored = anomaly.iqr_bounds(got, mode="centred").orderBy("metric", "ts").collect()
    for m, vals in SERIES.items():
        rows = [r for r in scored if r.metric == m]
        up, low = _pandas_bounds(vals)
        assert all(_close(u, r.up) for u, r in zip(up, rows)), m
        assert all(_close(lo, r.low) for lo, r in zip(low, rows)), m


def test_newest_mode_scores_each_slot_as_if_last(spark):
    got = _long(spark, SERIES)
    scored = anomaly.iqr_bounds(got, mode="newest").orderBy("metric", "ts").collect()
    for m, vals in SERIES.items():
        rows = [r for r in scored if r.metric == m]
        for i in range(len(vals)):
            up, low = _pandas_bounds(vals[: i + 1])
            assert _close(up[-1], rows[i].up) and _close(low[-1], rows[i].low), (m, i)
            v = vals[i]
            want = (v is not None and not math.isnan(up[-1])
                    and (v < low[-1] or v > up[-1]))
            assert rows[i].is_alert == bool(want), (m, i)


def test_current_alerts_direction_and_text(spark):
    scored = anomaly.iqr_bounds(_long(spark, SERIES), mode="newest")
    out = {r.metric: r for r in anomaly.current_alerts(scored).collect()}
    v = out["views"]
    assert v.ts == T0 + dt.timedelta(minutes=15 * 15) and v.value == 3.0 and v.prev_value == 13.0
    assert v.is_alert and v.direction == "drop"
    assert v.deviation_pct == 76.92
    assert v.text == "Anomaly (drop) in views: current value 3.00, deviation from previous 76.92%"
    c = out["CTR"]
    assert c.direction == "drop" and c.prev_value == 0.9


def test_slot_metrics_inner_join_and_range(make_feed, make_msgs):
    feed = make_feed([
        (1, "2024-01-07 23:59:00", "view", 0, 1, "iOS", "ads", 1, 30),   # before the range
        (1, "2024-01-08 00:01:00", "view", 0, 1, "iOS", "ads", 1, 30),
        (2, "2024-01-08 00:02:00", "like", 0, 1, "iOS", "ads", 1, 30),
        (2, "2024-01-08 00:20:00", "like", 0, 1, "iOS", "ads", 1, 30),   # slot with no messages
        (3, "2024-01-09 11:59:00", "view", 0, 1, "iOS", "ads", 1, 30),
        (3, "2024-01-09 12:01:00", "view", 0, 1, "iOS", "ads", 1, 30),   # open slot: excluded
    ])
    msgs = make_msgs([(1, 2, "2024-01-08 00:05:00"), (1, 3, "2024-01-08 00:06:00"),
                      (5, 3, "2024-01-09 11:50:00"), (5, 3, "2024-01-09 12:03:00")])
    rows = anomaly.slot_metrics(feed, msgs, "2024-01-09 12:07:00").orderBy("ts").collect()
    assert [(r.hm, r.users_feed, r.views, r.likes, r.CTR, r.users_mess, r.sent_mess) for r in rows] == [
        ("00:00", 2, 1, 1, 1.0, 1, 2), ("11:45", 1, 1, 0, 0.0, 1, 1)]


def test_union_chain_equals_join_of_slot_aggregates_with_null_users(make_feed, make_msgs):
    feed = make_feed([
        (1, "2024-01-08 00:01:00", "view", 0, 1, "iOS", "ads", 1, 30),
        (None, "2024-01-08 00:02:00", "like", 0, 1, "iOS", "ads", 1, 30),   # counted, not a user
        (None, "2024-01-08 00:16:00", "view", 0, 1, "iOS", "ads", 1, 30),   # only a NULL user
        (2, "2024-01-08 00:31:00", "view", 0, 1, "iOS", "ads", 1, 30),      # feed only
    ])
    msgs = make_msgs([(1, 2, "2024-01-08 00:03:00"), (None, 2, "2024-01-08 00:04:00"),
                      (None, 3, "2024-01-08 00:17:00"),                     # only a NULL sender
                      (4, 5, "2024-01-08 00:47:00")])                       # messages only
    as_of = "2024-01-09 12:07:00"
    from feedlens.operators.filters import closed_slots
    want = anomaly.finish_slots(anomaly.feed_slots(closed_slots(feed, as_of)),
                                anomaly.message_slots(closed_slots(msgs, as_of)))
    got = anomaly.slot_metrics(feed, msgs, as_of)
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(got) == key(want)
    assert [(r.hm, r.users_feed, r.views, r.likes, r.users_mess, r.sent_mess)
            for r in got.orderBy("ts").collect()] == [("00:00", 1, 1, 1, 1, 1), ("00:15", 0, 1, 0, 0, 0)]
