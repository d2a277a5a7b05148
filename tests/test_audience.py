import datetime as dt

from feedlens.operators import audience

MON = [dt.date(2024, 1, 1) + dt.timedelta(days=7 * i) for i in range(5)]


def _feed(make_feed, activity):
    rows = []
    for user, weeks in activity.items():
        for w in weeks:
            t = dt.datetime.combine(MON[w] + dt.timedelta(days=user % 3), dt.time(12))  # Mon-Wed
            rows.append((user, t, "view", 0, 1, "iOS", "ads", 1, 30))
    return make_feed(rows)


ACT = {1: [0, 1, 2], 2: [0, 2], 3: [1], 4: [2, 3], 5: [3]}


def _brute(activity, run_date):
    """Set semantics of the source job over per-user week sets."""
    out = {}
    nxt = MON[0] + dt.timedelta(days=7 * ((run_date - MON[0]).days // 7 + 1))
    for weeks in activity.values():
        ws = {MON[w] for w in weeks if MON[w] <= run_date}
        for w in ws:
            st = "retained" if w - dt.timedelta(days=7) in ws else "new"
            out[(w, st)] = out.get((w, st), 0) + 1
            nw = w + dt.timedelta(days=7)
            if nw not in ws and nw != nxt:
                out[(nw, "gone")] = out.get((nw, "gone"), 0) - 1
    return out


def test_weekly_audience_matches_set_semantics(make_feed):
    run = MON[3] + dt.timedelta(days=2)
    got = {(r.Date, r.status): r.num_users
           for r in audience.weekly_audience(_feed(make_feed, ACT), run).collect()}
    assert got == {k: float(v) for k, v in _brute(ACT, run).items()}
    # property: retained + new = active users of the week
    for i in range(4):
        active = sum(1 for ws in ACT.values() if i in ws)
        assert got.get((MON[i], "new"), 0) + got.get((MON[i], "retained"), 0) == active
    # property: |gone(w+1)| + retained(w+1) = active(w)  (up to the current week)
    for i in range(3):
        active = sum(1 for ws in ACT.values() if i in ws)
        assert -got.get((MON[i + 1], "gone"), 0) + got.get((MON[i + 1], "retained"), 0) == active


def test_weekly_audience_wide_keeps_complete_weeks(make_feed):
    run = MON[3] + dt.timedelta(days=2)
    wide = audience.weekly_audience_wide(_feed(make_feed, ACT), run).collect()
    assert [r.Date for r in wide] == [MON[1], MON[2], MON[3]]
    r = wide[1]
    assert (r.gone, r.retained, r.new) == (-1.0, 1.0, 2.0)
