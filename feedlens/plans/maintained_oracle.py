"""DuckDB SQL for the queries of ``maintained``: each from the whole events, by definition."""

from __future__ import annotations

import datetime as dt

from feedlens.functions import xxh64 as x
from feedlens.plans import catalog as c
from feedlens.plans import maintained as m
from feedlens.plans import oracle as o
from feedlens.plans.oracle import D, _sql

_2_64 = "18446744073709551616::UHUGEINT"


def _xor(a: str, b: str) -> str:
    return f"CAST(xor(CAST({a} AS UBIGINT), CAST({b} AS UBIGINT)) AS UHUGEINT)"


def _rotl(a: str, r: int) -> str:
    return f"({a} * {1 << r}::UHUGEINT % {_2_64} + {a} // {1 << (64 - r)}::UHUGEINT)"


def _times(a: str, factor: int, plus: int = 0) -> str:
    return f"(({a} * {factor}::UHUGEINT % {_2_64} + {plus}::UHUGEINT) % {_2_64})"


def _xxh64(key: str, source: str, width: int) -> str:
    """A subquery: ``source`` with h, the published XXH64 (seed 0) of the key's bytes."""
    steps = [f"SELECT *, CAST({key} AS UHUGEINT) AS h FROM {source}"]
    begin = f"{(x.PRIME5 + width) % (1 << 64)}::UHUGEINT"
    if width == 8:
        rounds = [_times("h", x.PRIME2), _times(_rotl("h", 31), x.PRIME1), _xor("h", begin), _times(_rotl("h", 27), x.PRIME1, x.PRIME4)]
    else:
        rounds = [_times("h", x.PRIME1), _xor("h", begin), _times(_rotl("h", 23), x.PRIME2, x.PRIME3)]
    rounds += [_xor("h", f"h // {1 << 33}::UHUGEINT"), _times("h", x.PRIME2), _xor("h", f"h // {1 << 29}::UHUGEINT"), _times("h", x.PRIME3),
               _xor("h", f"h // {1 << 32}::UHUGEINT")]
    for r in rounds:
        steps.append(f"SELECT * REPLACE ({r} AS h) FROM ({steps[-1]})")
    return f"({steps[-1]})"


def _exact_ranks() -> str:
    """Mann-Whitney by enumerating every order of the values (normal approximation with ties)."""
    parts = []
    days = ("dc AS (SELECT exp_group, CAST(time AS DATE) AS day, " + o.CTR_SQL + " AS ctr FROM feed_actions "
            f"WHERE CAST(time AS DATE) BETWEEN {D(c.AB_LO)} AND {D(c.AB_HI)} GROUP BY 1, 2)")
    for a, b in m.EXACT_PAIRS:
        orders = ("od AS (SELECT list_sum([i FOR i IN range(n_a + n_b) IF (k >> i) & 1 = 1]) - n_a * (n_a - 1) / 2 AS u "
                  "FROM rs, range(CAST(pow(2, n_a + n_b) AS BIGINT)) r(k) WHERE bit_count(k) = n_a)")
        exact = "(SELECT least(1.0, 2.0 * count_if(u >= greatest(u_a, u_b)) / count(*)) FROM od)"
        parts.append("SELECT * FROM (" + _sql(
            f"SELECT CAST({a} AS INTEGER) AS a, CAST({b} AS INTEGER) AS b, n_a, n_b, u_a, u_b, CASE WHEN tie_term = 0 THEN {exact} ELSE p_value END AS p_value, "
            "CASE WHEN tie_term = 0 THEN 'exact' ELSE 'asymptotic' END AS method FROM zp",
            days, *o._mw_ctes("dc", "ctr", a, b), orders, f"zp AS ({o._z_tail('mz')})", doubles=["u_a", "u_b", "p_value"]) + ")")
    return " UNION ALL ".join(parts)


def _cube_of_days() -> str:
    sums = ", ".join(f"CAST(sum({n}) AS BIGINT) AS {n}" for n in o.COUNTERS)
    day = "CAST(time AS DATE)"
    return _sql(
        " UNION ALL ".join(f"SELECT d AS event_date, '{dim}' AS dimension, {column} AS dimension_value, {sums} FROM m GROUP BY d, {column}"
                           for dim, column in (("os", "os"), ("gender", "gender_label"), ("age", "age_group"))),
        f"fu AS (SELECT {day} AS d, user_id, os, {o.AGE_SQL['reference']} AS age_group, {o.GENDER_SQL} AS gender_label, {o.CNT_VIEW} AS views, "
        f"{o.CNT_LIKE} AS likes FROM feed_actions GROUP BY 1, 2, 3, 4, 5)",
        f"ms AS (SELECT {day} AS d, user_id, count(reciever_id) AS messages_sent, count(DISTINCT reciever_id) AS users_sent FROM message_actions GROUP BY 1, 2)",
        f"mr AS (SELECT {day} AS d, reciever_id AS user_id, count(user_id) AS messages_received, count(DISTINCT user_id) AS users_received FROM message_actions GROUP BY 1, 2)",
        "m AS (SELECT d, user_id, os, gender_label, age_group, views, likes, messages_sent, users_sent, coalesce(messages_received, 0) AS messages_received, "
        "coalesce(users_received, 0) AS users_received FROM fu JOIN ms USING (d, user_id) LEFT JOIN mr USING (d, user_id))")


def _welch_running() -> str:
    ctes, parts = [], []
    for k in range((c.AB_HI - c.AB_LO).days + 1):
        day = c.AB_LO + dt.timedelta(days=k)
        ctes += [o._um_cte(f"um{k}", (c.AB_A, c.AB_B), c.AB_LO, day),
                 f"ll{k} AS (SELECT exp_group, likes - (SELECT CAST(sum(likes) AS DOUBLE) / NULLIF(sum(views), 0) FROM um{k} "
                 f"WHERE exp_group = {c.AB_A}) * views AS linearized_likes FROM um{k})"]
        parts += [o._welch_select(source, value, c.AB_A, c.AB_B, extra=f"{D(day)} AS \"Date\", '{value}' AS metric, ")
                  for source, value in ((f"um{k}", "ctr"), (f"ll{k}", "linearized_likes"))]
    return _sql(" UNION ALL ".join(parts), *ctes, doubles=o.WELCH_DOUBLES)


def maintained_sql(plain: dict[str, str]) -> dict[str, str]:
    """DuckDB SQL by query; ``plain``: the SQL of the queries over plain scans."""
    q = {}
    active = ("act AS (SELECT CAST(time AS DATE) AS d, user_id FROM feed_actions WHERE user_id IS NOT NULL UNION "
              "SELECT CAST(time AS DATE), user_id FROM message_actions WHERE user_id IS NOT NULL)")
    lengths = ", ".join(f"({n})" for n in m.WINDOWS)
    q["rolling_users"] = _sql(
        f"SELECT g.d AS \"Date\", CAST(n AS INTEGER) AS days, count(DISTINCT user_id) AS users FROM (SELECT CAST({D(m.FIRST_DAY)} + CAST(i AS INTEGER) AS DATE) AS d "
        f"FROM range({(m.LAST_DAY - m.FIRST_DAY).days + 1}) r(i)) g, (VALUES {lengths}) w(n), act WHERE act.d BETWEEN g.d - (n - 1) AND g.d "
        f"AND act.d BETWEEN {D(m.FIRST_DAY)} AND {D(m.LAST_DAY)} GROUP BY 1, 2", active)
    q["feed_kpis_approx"] = plain["feed_kpis_week"]
    q["hourly_users_approx"] = plain["hourly_users"]
    lo = c.RUN_DATE - dt.timedelta(days=6)
    starts = {"hour": "date_trunc('hour', time)", "day": "CAST(date_trunc('day', time) AS TIMESTAMP)", "range": f"CAST({D(lo)} AS TIMESTAMP)"}
    q["users_by_grain"] = _sql(
        " UNION ALL ".join(f"SELECT '{grain}' AS grain, {service} AS service, {start} AS start, count(DISTINCT user_id) AS users FROM ev GROUP BY 1, 2, 3"
                           for grain, start in starts.items() for service in ("service", "'all'")),
        f"ev AS (SELECT * FROM (SELECT 'feed' AS service, time, user_id FROM feed_actions UNION ALL SELECT 'message', time, user_id FROM message_actions) e "
        f"WHERE CAST(time AS DATE) BETWEEN {D(lo)} AND {D(c.RUN_DATE)})")
    q["weekly_audience_maintained"] = plain["weekly_audience"]
    q["weekly_audience_wide_maintained"] = f"SELECT * FROM ({plain['weekly_audience_wide']}) w WHERE \"Date\" >= DATE '2024-01-08'"
    q["mann_whitney_exact"] = _exact_ranks()
    hashed = _xxh64("user_id", "um", 8)
    buckets = (f"ub AS (SELECT exp_group, CAST(h % {c.N_BUCKETS} AS BIGINT) AS bucket, user_id, likes, views, ctr FROM {hashed})", o.BUCKET_CTE[1])
    q["bucket_metrics_xxh64"] = _sql("SELECT * FROM bm", o.UM_AB, *buckets, doubles=["bucket_ctr", "ctr9"])
    q["user_buckets_xxh64"] = _sql(f"SELECT user_id, CAST(h % {c.N_BUCKETS} AS BIGINT) AS bucket FROM {_xxh64('user_id', '(SELECT DISTINCT user_id FROM feed_actions)', 4)}")
    q["cube_late_events"] = _cube_of_days()
    q["daily_cube_bucketed"] = plain["daily_cube"]
    q["welch_running"] = _welch_running()
    q["sketched_quantiles"] = _sql(
        "SELECT exp_group, os, list_sort(list(s))[least(CAST(floor(0.9 * count(*)) AS BIGINT), count(*) - 1) + 1] AS quantile FROM "
        "(SELECT exp_group, os, CAST(hour(time) * 3600 + minute(time) * 60 + second(time) AS INTEGER) AS s FROM feed_actions "
        f"WHERE CAST(time AS DATE) BETWEEN {D(c.AB_LO)} AND {D(c.AB_HI)}) e GROUP BY 1, 2")
    q["new_users_filtered"] = _sql(
        "SELECT first_date, count(*) AS n_new FROM (SELECT user_id, min(CAST(time AS DATE)) AS first_date FROM feed_actions "
        f"WHERE user_id IS NOT NULL AND CAST(time AS DATE) <= {D(c.YESTERDAY)} GROUP BY 1) u GROUP BY 1")
    return q
