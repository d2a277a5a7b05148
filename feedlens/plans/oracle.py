"""DuckDB SQL equivalents of the catalog queries (the correctness oracle).

Written independently of the Spark plans where that makes the check stronger
(e.g. weekly audience as a self-join + NOT EXISTS, Mann-Whitney as one global
running sum, the A/A draw without thinning). Each string runs on the
pre-registered ``events`` view; the fixture views are CTEs.
"""

from __future__ import annotations

import datetime as dt
import re

from feedlens.plans import catalog as c
from feedlens.sources.fixtures import DUCKDB_DAYS, FEED_VIEW_SQL, MESSAGE_VIEW_SQL

FIXTURE = (f"feed_actions AS ({FEED_VIEW_SQL.replace('{days}', DUCKDB_DAYS)}),\n"
           f"message_actions AS ({MESSAGE_VIEW_SQL})")


def D(d) -> str:
    """DuckDB date literal."""
    return f"DATE '{d.isoformat()}'"


def TS(t) -> str:
    """DuckDB timestamp literal."""
    return f"TIMESTAMP '{t.strftime('%Y-%m-%d %H:%M:%S')}'"


def _sql(select: str, *ctes: str, doubles=()) -> str:
    body = "WITH " + ",\n".join((FIXTURE,) + ctes) + "\n" + select
    if not doubles:
        return body
    rep = ", ".join(f'round(round("{x}" * 1000000000.0) / 1000000000.0 * 1000000.0) / 1000000.0 + 0.0 AS "{x}"'
                    for x in doubles)
    return f"SELECT * REPLACE ({rep}) FROM (\n{body}\n) q"


Y = c.YESTERDAY
DAY_FILTER = f"CAST(time AS DATE) = {D(Y)}"
UPTO_Y = f"time < {TS(c.RUN_DATE)}"
CNT_VIEW = "CAST(count_if(action = 'view') AS BIGINT)"
CNT_LIKE = "CAST(count_if(action = 'like') AS BIGINT)"
CTR_SQL = "CAST(count_if(action = 'like') AS DOUBLE) / NULLIF(count_if(action = 'view'), 0)"

AGE_SQL = {
    "reference": ("CASE WHEN age <= 20 THEN '0 - 20' WHEN age > 20 AND age <= 30 THEN '21-30' "
                  "WHEN age > 31 AND age <= 40 THEN '31-40' ELSE '41+' END"),
    "fixed": ("CASE WHEN age <= 20 THEN '0 - 20' WHEN age > 20 AND age <= 30 THEN '21-30' "
              "WHEN age > 30 AND age <= 40 THEN '31-40' ELSE '41+' END"),
}
GENDER_SQL = "CASE WHEN gender = 1 THEN 'male' ELSE 'female' END"


def _kpis(where: str) -> str:
    return _sql(f"""SELECT CAST(time AS DATE) AS "Date", {CNT_VIEW} AS views, {CNT_LIKE} AS likes,
  {CTR_SQL} AS "CTR",
  count(DISTINCT user_id) AS "DAU"
FROM feed_actions WHERE {where} GROUP BY 1""", doubles=["CTR"])


def _first_seen(keys: str) -> str:
    return (f"SELECT {keys} FROM feed_actions WHERE {UPTO_Y} GROUP BY {keys} "
            f"HAVING min(CAST(time AS DATE)) = {D(Y)}")


FEED_DAY_CTE = (f"d AS (SELECT {CNT_VIEW} AS views, {CNT_LIKE} AS likes, "
                f"count(DISTINCT user_id) AS dau FROM feed_actions WHERE {DAY_FILTER})")
APP_CTES = (
    f"t AS (SELECT count(DISTINCT user_id) AS total FROM feed_actions WHERE {DAY_FILTER})",
    f"n AS (SELECT count(user_id) AS new_users FROM ({_first_seen('user_id')}) x)",
    f"s AS (SELECT CAST(count_if(source = 'ads' AND user_id IS NOT NULL) AS BIGINT) AS ads, "
    f"CAST(count_if(source = 'organic' AND user_id IS NOT NULL) AS BIGINT) AS organic FROM ({_first_seen('user_id, source')}) x)",
    f"p AS (SELECT count(post_id) AS new_posts FROM ({_first_seen('post_id')}) x)",
)


def _nz(x: str) -> str:
    return f"COALESCE(CAST({x} AS VARCHAR), 'n/a')"


def _feed_by_user_cte(bins: str) -> str:
    return (f"fu AS (SELECT user_id, {CNT_VIEW} AS views, {CNT_LIKE} AS likes, os, "
            f"{AGE_SQL[bins]} AS age_group, {GENDER_SQL} AS gender_label "
            f"FROM feed_actions WHERE {DAY_FILTER} GROUP BY user_id, os, age_group, gender_label)")


MSG_CTES = (
    f"mday AS (SELECT * FROM message_actions WHERE {DAY_FILTER})",
    "ms AS (SELECT user_id, count(reciever_id) AS messages_sent, count(DISTINCT reciever_id) AS users_sent "
    "FROM mday GROUP BY user_id)",
    "mr AS (SELECT reciever_id, count(user_id) AS messages_received, count(DISTINCT user_id) AS users_received "
    "FROM mday GROUP BY reciever_id)",
    "mu AS (SELECT ms.user_id, messages_sent, users_sent, COALESCE(messages_received, 0) AS messages_received, "
    "COALESCE(users_received, 0) AS users_received FROM ms LEFT JOIN mr ON ms.user_id = mr.reciever_id)",
)
COUNTERS = ["views", "likes", "messages_sent", "users_sent", "messages_received", "users_received"]


def _cube(bins: str) -> str:
    sums = ", ".join(f"CAST(sum({x}) AS BIGINT) AS {x}" for x in COUNTERS)
    parts = [f"SELECT {D(Y)} AS event_date, '{dim}' AS dimension, {col} AS dimension_value, {sums} "
             f"FROM m GROUP BY {col}"
             for dim, col in (("os", "os"), ("gender", "gender_label"), ("age", "age_group"))]
    return _sql("\nUNION ALL ".join(parts), _feed_by_user_cte(bins), *MSG_CTES,
                "m AS (SELECT * FROM fu JOIN mu USING (user_id))")


def _cube_dedupe(bins: str) -> str:
    msg_cols = ", ".join(f"max({x}) AS {x}" for x in COUNTERS[2:])
    sums = ", ".join(f"CAST(sum({x}) AS BIGINT) AS {x}" for x in COUNTERS)
    parts = [f"SELECT '{dim}' AS dimension, {col} AS dimension_value, user_id, sum(views) AS views, "
             f"sum(likes) AS likes, {msg_cols} FROM m GROUP BY {col}, user_id"
             for dim, col in (("os", "os"), ("gender", "gender_label"), ("age", "age_group"))]
    return _sql(f"SELECT {D(Y)} AS event_date, dimension, dimension_value, {sums} FROM pu "
                "GROUP BY dimension, dimension_value",
                _feed_by_user_cte(bins), *MSG_CTES,
                "m AS (SELECT * FROM fu JOIN mu USING (user_id))",
                "pu AS (" + " UNION ALL ".join(parts) + ")")


WEEKLY_CTES = (
    f"uw AS (SELECT DISTINCT user_id, CAST(date_trunc('week', CAST(time AS DATE)) AS DATE) AS w "
    f"FROM feed_actions WHERE time < {TS(c.WEEKLY_RUN_DATE + dt.timedelta(days=1))})",
    "nr AS (SELECT a.w AS d, CASE WHEN b.user_id IS NULL THEN 'new' ELSE 'retained' END AS status, "
    "count(*) AS n FROM uw a LEFT JOIN uw b ON a.user_id = b.user_id AND b.w = a.w - 7 GROUP BY 1, 2)",
    "gn AS (SELECT a.w + 7 AS d, 'gone' AS status, -count(*) AS n FROM uw a WHERE NOT EXISTS "
    "(SELECT 1 FROM uw b WHERE b.user_id = a.user_id AND b.w = a.w + 7) "
    f"AND a.w + 7 <> {D(c.WEEKLY_RUN_DATE - dt.timedelta(days=c.WEEKLY_RUN_DATE.weekday() - 7))} "
    "GROUP BY 1)",
    "wa AS (SELECT d AS \"Date\", status, CAST(n AS DOUBLE) AS num_users FROM nr "
    "UNION ALL SELECT d, status, CAST(n AS DOUBLE) FROM gn)",
)

# closed slots as of 2024-01-09 12:07: from the start of the day before to the slot's start
SLOT_WHERE = "time >= TIMESTAMP '2024-01-08 00:00:00' AND time < TIMESTAMP '2024-01-09 12:00:00'"
SLOT_CTES = (
    "sf AS (SELECT time_bucket(INTERVAL 15 MINUTE, time) AS ts, count(DISTINCT user_id) AS users_feed, "
    f"{CNT_VIEW} AS views, {CNT_LIKE} AS likes FROM feed_actions WHERE {SLOT_WHERE} GROUP BY 1)",
    "sm AS (SELECT time_bucket(INTERVAL 15 MINUTE, time) AS ts, count(DISTINCT user_id) AS users_mess, "
    f"count(user_id) AS sent_mess FROM message_actions WHERE {SLOT_WHERE} GROUP BY 1)",
    "slots AS (SELECT sf.ts, CAST(sf.ts AS DATE) AS \"date\", strftime(sf.ts, '%H:%M') AS hm, users_feed, "
    "views, likes, CAST(likes AS DOUBLE) / NULLIF(views, 0) AS \"CTR\", users_mess, sent_mess "
    "FROM sf JOIN sm ON sf.ts = sm.ts)",
)
METRICS = ["users_feed", "views", "likes", "CTR", "users_mess", "sent_mess"]
LONG_CTE = ("lng AS (" + " UNION ALL ".join(
    f"SELECT ts, '{m}' AS metric, CAST(\"{m}\" AS DOUBLE) AS value FROM slots" for m in METRICS) + ")")


def _scored_ctes(mode: str) -> tuple[str, ...]:
    hi = "2 FOLLOWING" if mode == "centred" else "CURRENT ROW"
    return SLOT_CTES + (
        LONG_CTE,
        "qb AS (SELECT ts, metric, value, "
        "CASE WHEN count(value) OVER w6 = 6 THEN quantile_cont(value, 0.25) OVER w6 END AS q25, "
        "CASE WHEN count(value) OVER w6 = 6 THEN quantile_cont(value, 0.75) OVER w6 END AS q75 "
        "FROM lng WINDOW w6 AS (PARTITION BY metric ORDER BY ts ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING))",
        "rb AS (SELECT *, q75 - q25 AS iqr, q75 + 2.0 * (q75 - q25) AS up_raw, "
        "q25 - 2.0 * (q75 - q25) AS low_raw FROM qb)",
        "sb AS (SELECT ts, metric, value, q25, q75, iqr, avg(up_raw) OVER ws AS up, avg(low_raw) OVER ws AS low "
        f"FROM rb WINDOW ws AS (PARTITION BY metric ORDER BY ts ROWS BETWEEN 3 PRECEDING AND {hi}))",
        "scored AS (SELECT *, COALESCE(value < low OR value > up, false) AS is_alert FROM sb)",
    )


def _um_cte(name: str, groups, lo, hi) -> str:
    g = ", ".join(str(x) for x in groups)
    return (f"{name} AS (SELECT exp_group, user_id, {CNT_LIKE} AS likes, {CNT_VIEW} AS views, "
            f"{CTR_SQL} AS ctr "
            f"FROM feed_actions WHERE CAST(time AS DATE) BETWEEN {D(lo)} AND {D(hi)} "
            f"AND exp_group IN ({g}) GROUP BY exp_group, user_id)")


UM_AB = _um_cte("um", (c.AB_A, c.AB_B), c.AB_LO, c.AB_HI)
WELCH_DOUBLES = ["mean_a", "mean_b", "var_a", "var_b", "t", "df"]


def _welch_select(src: str, value: str, a, b, extra: str = "") -> str:
    va, vb = f"CASE WHEN exp_group = {a} THEN {value} END", f"CASE WHEN exp_group = {b} THEN {value} END"
    return (f"SELECT {extra}n_a, n_b, mean_a, mean_b, var_a, var_b, n_undefined, "
            "(mean_a - mean_b) / sqrt(var_a / n_a + var_b / n_b) AS t, "
            "(var_a / n_a + var_b / n_b) * (var_a / n_a + var_b / n_b) / "
            "((var_a / n_a) * (var_a / n_a) / (n_a - 1) + (var_b / n_b) * (var_b / n_b) / (n_b - 1)) AS df "
            f"FROM (SELECT count({va}) AS n_a, count({vb}) AS n_b, avg({va}) AS mean_a, avg({vb}) AS mean_b, "
            f"var_samp({va}) AS var_a, var_samp({vb}) AS var_b, "
            f"CAST(count_if(exp_group IN ({a}, {b}) AND {value} IS NULL) AS BIGINT) AS n_undefined "
            f"FROM {src} WHERE exp_group IN ({a}, {b})) w")


def _smoothed_cte(src: str = "um") -> tuple[str, ...]:
    return (f"gt AS (SELECT exp_group, CAST(sum(likes) AS DOUBLE) / NULLIF(sum(views), 0) AS g FROM {src} "
            "GROUP BY exp_group)",
            f"sm_ctr AS (SELECT u.exp_group, user_id, likes, views, ctr, "
            f"(likes + {c.ALPHA_SMOOTH!r} * g) / (views + {c.ALPHA_SMOOTH!r}) AS smoothed_ctr "
            f"FROM {src} u JOIN gt USING (exp_group))")


def _md5_u32(expr: str) -> str:
    return f"CAST('0x' || substr(md5({expr}), 1, 8) AS BIGINT)"


BUCKET_CTE = (
    f"ub AS (SELECT exp_group, {_md5_u32('CAST(user_id AS VARCHAR)')} % {c.N_BUCKETS} AS bucket, "
    "user_id, likes, views, ctr FROM um)",
    "bm AS (SELECT exp_group, bucket, CAST(sum(likes) AS DOUBLE) / NULLIF(sum(views), 0) AS bucket_ctr, "
    "list_sort(list(ctr) FILTER (WHERE ctr IS NOT NULL))"
    "[least(CAST(floor(0.9 * count(ctr)) AS BIGINT), count(ctr) - 1) + 1] AS ctr9 "
    "FROM ub GROUP BY exp_group, bucket)",
)


def _mw_ctes(src: str, value: str, a, b) -> tuple[str, ...]:
    """U, P(A > B) and ties from all pairs of values, by their definitions."""
    return (
        f"va AS (SELECT {value} AS x FROM {src} WHERE exp_group = {a} AND {value} IS NOT NULL)",
        f"vb AS (SELECT {value} AS y FROM {src} WHERE exp_group = {b} AND {value} IS NOT NULL)",
        "pc AS (SELECT CAST(count_if(x > y) AS DOUBLE) AS a_gt, CAST(count_if(x = y) AS DOUBLE) AS ties, "
        "CAST(count_if(x < y) AS DOUBLE) AS a_lt FROM va, vb)",
        "tt AS (SELECT CAST(sum(pow(m, 3) - m) AS DOUBLE) AS tie_term FROM (SELECT v, count(*) AS m FROM "
        "(SELECT x AS v FROM va UNION ALL SELECT y FROM vb) z GROUP BY v) g)",
        "rs AS (SELECT (SELECT count(*) FROM va) AS n_a, (SELECT count(*) FROM vb) AS n_b, a_gt + ties / 2 AS u_a, a_gt, ties, a_lt, "
        f"tie_term, (SELECT count(*) FROM {src} WHERE exp_group IN ({a}, {b}) AND {value} IS NULL) AS n_undefined FROM pc, tt)",
        # the normal approximation: U's mean and variance under no difference, ties corrected
        "mw AS (SELECT *, a_lt + ties / 2 AS u_b, n_a * n_b / 2.0 AS mu, "
        "sqrt(n_a * n_b * ((n_a + n_b + 1) / 12.0 - tie_term / (12.0 * (n_a + n_b) * (n_a + n_b - 1)))) AS sigma FROM rs)",
        "mz AS (SELECT *, (greatest(u_a, u_b) - mu - 0.5) / sigma AS z FROM mw)",
    )


MW_SELECT = "SELECT n_a, n_b, u_a, u_b, tie_term, z, n_undefined FROM mz"
MW_DOUBLES = ["u_a", "u_b", "tie_term", "z"]

# Tails by integrating the densities (Simpson's rule over SIMPSON steps).
SIMPSON = 600
WEIGHT = f"CASE WHEN i IN (0, {SIMPSON}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"


def _t_tail(src: str, key: str = "rid") -> str:
    """CTE body: ``src`` (with t, df and a unique ``key``) and its two-sided Student-t p."""
    density = "exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(pi() * df) * pow(1 + pow(abs(t) * i / {n}, 2) / df, -(df + 1) / 2)".format(n=float(SIMPSON))
    return (f"SELECT s.*, p.p_value FROM {src} s LEFT JOIN (SELECT {key}, greatest(0.0, 1 - 2 * sum({WEIGHT} * {density}) * any_value(abs(t)) / (3 * {SIMPSON})) AS p_value "
            f"FROM {src}, range({SIMPSON} + 1) r(i) WHERE t IS NOT NULL GROUP BY {key}) p USING ({key})")


def _z_tail(src: str) -> str:
    """CTE body: ``src`` (with z, one row) and its two-sided normal p; 1 below z = 0."""
    density = f"exp(-pow(abs(z) * i / {float(SIMPSON)}, 2) / 2) / sqrt(2 * pi())"
    return (f"SELECT s.*, CASE WHEN z < 0 THEN 1.0 ELSE p END AS p_value FROM {src} s, "
            f"(SELECT 1 - 2 * sum({WEIGHT} * {density}) * any_value(abs(z)) / (3 * {SIMPSON}) AS p FROM {src}, range({SIMPSON} + 1) r(i)) q")


# Poisson bootstrap over distinct (group, likes, views): one Poisson(m) draw for m like
# users, at most 256 of them together; P(X <= k) summed from the probabilities.
BOOT_CTES = (
    "lk AS (SELECT exp_group, likes, views, count(*) AS m FROM um GROUP BY ALL)",
    "pt AS (SELECT exp_group, likes, views, part, least(256, m - part * 256) AS m FROM lk, LATERAL (SELECT unnest(range(0, (m + 255) // 256)) AS part) x)",
    "cd AS (SELECT m, k, floor(sum(exp(-m + k * ln(m) - lgamma(k + 1))) OVER (PARTITION BY m ORDER BY k) * 4294967296) AS t "
    "FROM (SELECT DISTINCT m FROM pt) u, range(0, 700) r(k))",
    f"rep AS (SELECT pt.*, CAST(r AS INTEGER) AS replicate, {_md5_u32(str(c.SEED) + " || '-' || exp_group || '-' || likes || '-' || views || '-' || part || '-' || r")} AS h "
    f"FROM pt, range({c.N_BOOT}) t(r))",
    "wr AS (SELECT rep.exp_group, rep.likes, rep.views, rep.part, rep.replicate, count(cd.k) AS w FROM rep LEFT JOIN cd ON cd.m = rep.m AND cd.t <= rep.h GROUP BY ALL)",
    "br AS (SELECT replicate, "
    f"CAST(sum(CASE WHEN exp_group = {c.AB_A} THEN w * likes END) AS BIGINT) AS num_a, "
    f"CAST(sum(CASE WHEN exp_group = {c.AB_A} THEN w * views END) AS BIGINT) AS den_a, "
    f"CAST(sum(CASE WHEN exp_group = {c.AB_B} THEN w * likes END) AS BIGINT) AS num_b, "
    f"CAST(sum(CASE WHEN exp_group = {c.AB_B} THEN w * views END) AS BIGINT) AS den_b FROM wr GROUP BY replicate)",
    "bx AS (SELECT *, CAST(num_a AS DOUBLE) / NULLIF(den_a, 0) AS ctr_a, CAST(num_b AS DOUBLE) / NULLIF(den_b, 0) "
    "AS ctr_b FROM br)",
    "bd AS (SELECT *, ctr_b - ctr_a AS diff FROM bx)",
    "bs AS (SELECT count(diff) AS n_replicates, avg(diff) AS mean_diff, min(diff) AS min_diff, max(diff) AS max_diff, "
    "quantile_cont(diff, 0.025) AS p025, quantile_cont(diff, 0.975) AS p975, count_if(diff > 0) / count(diff) AS share_positive, "
    "quantile_cont(diff, 0.025) <= 0 AND quantile_cont(diff, 0.975) >= 0 AS ci_crosses_zero, "
    "min(diff) <= 0 AND max(diff) >= 0 AS range_crosses_zero, "
    "least(1.0, 2.0 * least(1 + count_if(diff <= 0), 1 + count_if(diff >= 0)) / (count(diff) + 1)) AS p_value FROM bd)",
)


def _draw_ctes(um: str, n_iter: int, k: int) -> tuple[str, ...]:
    """sel (iter, exp_group, user_id, ctr): per iteration and group the first k different of
    enough hashed places in the group's users, numbered by (4096 hash buckets, id); where k
    is over half of them, all but the first n - k."""
    bucket = _md5_u32("CAST(user_id AS VARCHAR)") + " % 4096"
    needed = "CASE WHEN m <= 1 THEN m ELSE CAST(ceil(m - 1 + (m - 1 - ln(1e-14)) / -ln((m - 1) / n)) AS BIGINT) END"
    place = _md5_u32(str(c.SEED) + " || '-' || exp_group || '-' || i || '-' || j")
    return (
        f"pop AS (SELECT exp_group, user_id, ctr, row_number() OVER (PARTITION BY exp_group ORDER BY {bucket}, user_id) - 1 AS idx, "
        f"count(*) OVER (PARTITION BY exp_group) AS n FROM {um} WHERE ctr IS NOT NULL)",
        f"gm AS (SELECT DISTINCT exp_group, n, {2 * k} > n AS rest, CASE WHEN {2 * k} > n THEN n - {k} ELSE {k} END AS m FROM pop)",
        f"tr AS (SELECT exp_group, m, i, j, CAST(floor({place} * n / 4294967296.0) AS BIGINT) AS idx FROM "
        f"(SELECT exp_group, n, m, i, unnest(range({needed})) AS j FROM gm, range({n_iter}) r(i)) x)",
        "fi AS (SELECT exp_group, i, idx, min(j) AS j FROM tr GROUP BY exp_group, m, i, idx "
        "QUALIFY row_number() OVER (PARTITION BY exp_group, i ORDER BY min(j)) <= m)",
        "sel AS (SELECT CAST(i AS INTEGER) AS iter, exp_group, user_id, ctr FROM fi JOIN pop USING (exp_group, idx) JOIN gm USING (exp_group) WHERE NOT rest "
        f"UNION ALL SELECT CAST(i AS INTEGER), exp_group, user_id, ctr FROM pop JOIN gm USING (exp_group) JOIN range({n_iter}) r(i) ON rest "
        "ANTI JOIN fi USING (exp_group, i, idx))",
    )


AA_CTES = (_um_cte("ua", (c.AA_A, c.AA_B), c.AA_LO, c.AA_HI), *_draw_ctes("ua", c.AA_ITER, c.AA_K))


def _welch_select_grouped() -> str:
    a, b = c.AA_A, c.AA_B
    va, vb = f"CASE WHEN exp_group = {a} THEN ctr END", f"CASE WHEN exp_group = {b} THEN ctr END"
    return ("SELECT iter, n_a, n_b, mean_a, mean_b, var_a, var_b, "
            "(mean_a - mean_b) / sqrt(var_a / n_a + var_b / n_b) AS t, "
            "(var_a / n_a + var_b / n_b) * (var_a / n_a + var_b / n_b) / "
            "((var_a / n_a) * (var_a / n_a) / (n_a - 1) + (var_b / n_b) * (var_b / n_b) / (n_b - 1)) AS df "
            f"FROM (SELECT iter, count({va}) AS n_a, count({vb}) AS n_b, avg({va}) AS mean_a, avg({vb}) AS mean_b, "
            f"var_samp({va}) AS var_a, var_samp({vb}) AS var_b FROM sel GROUP BY iter) w")


def _ab_summary() -> str:
    """Every test of the A/B table from the definitions above; control = group a."""
    a, b = c.AB_A, c.AB_B
    lin = (f"ll AS (SELECT exp_group, likes - (SELECT CAST(sum(likes) AS DOUBLE) / NULLIF(sum(views), 0) FROM um WHERE exp_group = {a}) * views "
           "AS linearized_likes FROM um)")
    welch = " UNION ALL ".join(_welch_select(src, value, a, b, extra=f"'{name}' AS metric, ") for src, value, name in (
        ("um", "ctr", "ctr"), ("sm_ctr", "smoothed_ctr", f"smoothed_ctr_alpha_{c.ALPHA_SMOOTH:g}"), ("ll", "linearized_likes", "linearized_likes"),
        ("bm", "bucket_ctr", "bucket_ctr")))
    names = "va|vb|pc|tt|rs|mw|mz"
    bucket = [re.sub(rf"\b({names})\b", r"b_\1", x) for x in _mw_ctes("bm", "bucket_ctr", a, b)]
    return _sql(
        "SELECT 'welch_t' AS test, metric, n_a, n_b, t AS statistic, p_value FROM wp UNION ALL "
        "SELECT 'mann_whitney', 'ctr', n_a, n_b, u_a, p_value FROM up UNION ALL "
        "SELECT 'prob_a_gt_b', 'ctr', n_a, n_b, a_gt / (n_a * n_b), NULL FROM rs UNION ALL "
        f"SELECT 'poisson_bootstrap', 'global_ctr_diff', (SELECT count(*) FROM um WHERE exp_group = {a}), "
        f"(SELECT count(*) FROM um WHERE exp_group = {b}), mean_diff, p_value FROM bs UNION ALL "
        "SELECT 'mann_whitney', 'bucket_ctr', n_a, n_b, u_a, p_value FROM bp",
        UM_AB, *_smoothed_cte(), lin, *BUCKET_CTE, *_mw_ctes("um", "ctr", a, b), *bucket, *BOOT_CTES,
        f"ww AS (SELECT *, metric AS rid FROM ({welch}) w0)", f"wp AS ({_t_tail('ww')})",
        f"up AS ({_z_tail('mz')})", f"bp AS ({_z_tail('b_mz')})", doubles=["statistic", "p_value"])


DIRECTION = "CASE WHEN value > prev_value THEN 'growth' WHEN value < prev_value THEN 'drop' ELSE 'flat' END"
DEVIATION = "abs(round_even((1.0 - value / NULLIF(prev_value, 0)) * 100, 2))"
WITH_PREVIOUS = "SELECT *, lag(value) OVER (PARTITION BY metric ORDER BY ts) AS prev_value FROM scored"
ALERT_COLUMNS = (
    f"ts, metric, value, prev_value, low, up, is_alert, value IS NULL AS undefined, {DEVIATION} AS deviation_pct, "
    f"{DIRECTION} AS direction, CASE WHEN is_alert THEN 'Anomaly (' || {DIRECTION} || ') in ' || metric || "
    f"': current value ' || COALESCE(printf('%.2f', round_even(value, 2)), 'n/a') || "
    f"', deviation from previous ' || COALESCE(printf('%.2f', {DEVIATION}), 'n/a') || '%' "
    "WHEN value IS NULL THEN 'Undefined value of ' || metric END AS text")
ALERT_DOUBLES = ["value", "prev_value", "low", "up", "deviation_pct"]
# final slots: slot end + the 15-minute lateness allowance <= the newest event time of
# either source, whichever is the older
STREAM_CLOSED = ("ts + INTERVAL 30 MINUTE <= (SELECT least((SELECT max(time) FROM feed_actions), "
                 "(SELECT max(time) FROM message_actions)))")


def _alert_history() -> str:
    """The alert job's rows for each of its run times: the texts of the newest closed slot."""
    parts = []
    for as_of in sorted(set(c.ALERT_RUNS)):
        begin = dt.datetime.combine(as_of.date() - dt.timedelta(days=1), dt.time())
        end = as_of.replace(minute=as_of.minute // 15 * 15, second=0)
        where = f"time >= {TS(begin)} AND time < {TS(end)}"
        ctes = ",\n".join((FIXTURE, *(x.replace(SLOT_WHERE, where) for x in _scored_ctes("newest"))))
        parts.append(
            f"SELECT * FROM (WITH {ctes} SELECT CAST(ts AS DATE) AS report_date, 'alert' AS kind, strftime(ts, '%H-%M') AS slot, "
            f"{TS(as_of)} AS run_ts, text FROM (SELECT {ALERT_COLUMNS} FROM ({WITH_PREVIOUS}) e) x "
            "WHERE ts = (SELECT max(ts) FROM slots) AND text IS NOT NULL) y")
    return " UNION ALL ".join(parts)


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for every catalog query."""
    q: dict[str, str] = {}
    q["feed_kpis_day"] = _kpis(DAY_FILTER)
    q["feed_kpis_week"] = _kpis(
        f"CAST(time AS DATE) BETWEEN {D(c.RUN_DATE - dt.timedelta(days=6))} AND {D(c.RUN_DATE)}")
    pct = "CASE WHEN views > 0 THEN CAST(round_even(100.0 * likes / views, 0) AS BIGINT) END"
    q["feed_report"] = _sql(
        f"SELECT {D(Y)} AS report_date, 'feed' AS kind, 'Feed summary for {Y.isoformat()}: views ' || "
        f"{_nz('views')} || ', likes ' || {_nz('likes')} || ', CTR ' || {_nz(pct)} || '%, DAU ' || "
        f"{_nz('dau')} AS text FROM d", FEED_DAY_CTE)
    q["active_users"] = _sql(f"SELECT count(DISTINCT user_id) AS total FROM feed_actions WHERE {DAY_FILTER}")
    q["new_users"] = _sql("SELECT new_users FROM n", APP_CTES[1])
    q["new_users_by_source"] = _sql("SELECT ads, organic FROM s", APP_CTES[2])
    q["new_posts"] = _sql("SELECT new_posts FROM p", APP_CTES[3])
    lo14 = Y - dt.timedelta(days=13)
    q["avg_activity_14d"] = _sql(
        "SELECT d AS \"Date\", avg(views) AS avg_views, avg(likes) AS avg_likes FROM "
        f"(SELECT user_id, CAST(time AS DATE) AS d, {CNT_VIEW} AS views, {CNT_LIKE} AS likes FROM feed_actions "
        f"WHERE CAST(time AS DATE) BETWEEN {D(lo14)} AND {D(Y)} GROUP BY 1, 2) x GROUP BY d",
        doubles=["avg_views", "avg_likes"])
    q["hourly_users"] = _sql(
        "SELECT date_trunc('hour', time) AS hour, count(DISTINCT user_id) AS users, 'feed' AS service "
        f"FROM feed_actions WHERE {DAY_FILTER} GROUP BY 1 UNION ALL "
        "SELECT date_trunc('hour', time) AS hour, count(DISTINCT user_id) AS users, 'message' AS service "
        f"FROM message_actions WHERE {DAY_FILTER} GROUP BY 1")
    q["app_report"] = _sql(
        f"SELECT {D(Y)} AS report_date, 'app' AS kind, 'App summary for {Y.isoformat()}: active users ' || "
        f"{_nz('total')} || ', new users ' || {_nz('new_users')} || ' (ads ' || {_nz('ads')} || ', organic ' || "
        f"{_nz('organic')} || '), new posts ' || {_nz('new_posts')} AS text FROM t, n, s, p", *APP_CTES)
    q["app_report_maintained"] = q["app_report"]
    q["feed_by_user"] = _sql("SELECT user_id, views, likes, os, age_group, gender_label FROM fu",
                             _feed_by_user_cte("reference"))
    q["messages_by_user"] = _sql("SELECT * FROM mu", *MSG_CTES)
    q["daily_cube"] = _cube("reference")
    q["daily_cube_fixed_age"] = _cube("fixed")
    q["daily_cube_dedupe_messages"] = _cube_dedupe("reference")
    q["weekly_audience"] = _sql("SELECT * FROM wa", *WEEKLY_CTES)
    q["weekly_audience_wide"] = _sql(
        "SELECT \"Date\", gone, retained, new FROM (SELECT \"Date\", "
        "max(CASE WHEN status = 'gone' THEN num_users END) AS gone, "
        "max(CASE WHEN status = 'retained' THEN num_users END) AS retained, "
        "max(CASE WHEN status = 'new' THEN num_users END) AS new FROM wa GROUP BY \"Date\") x "
        "WHERE gone IS NOT NULL AND retained IS NOT NULL AND new IS NOT NULL", *WEEKLY_CTES)
    q["slot_metrics"] = _sql("SELECT * FROM slots", *SLOT_CTES, doubles=["CTR"])
    scored_doubles = ["value", "q25", "q75", "iqr", "up", "low"]
    q["iqr_bounds_centred"] = _sql("SELECT * FROM scored", *_scored_ctes("centred"), doubles=scored_doubles)
    q["iqr_bounds_newest"] = _sql("SELECT * FROM scored", *_scored_ctes("newest"), doubles=scored_doubles)
    q["current_alerts"] = _sql(
        f"SELECT {ALERT_COLUMNS} FROM ({WITH_PREVIOUS}) e "
        "QUALIFY row_number() OVER (PARTITION BY metric ORDER BY ts DESC) = 1",
        *_scored_ctes("newest"), doubles=ALERT_DOUBLES)
    closed = [x.replace(f"WHERE {SLOT_WHERE} ", "") for x in _scored_ctes("newest")]
    closed[2] = f"every_{closed[2]}"
    closed.insert(3, f"slots AS (SELECT * FROM every_slots WHERE {STREAM_CLOSED})")
    q["stream_alerts"] = _sql(f"SELECT {ALERT_COLUMNS} FROM ({WITH_PREVIOUS}) e", *closed, doubles=ALERT_DOUBLES)
    q["alert_history"] = _alert_history()
    q["alert_series"] = _sql("SELECT ts, metric, value, up, low FROM scored", *_scored_ctes("centred"),
                             doubles=["value", "up", "low"])
    q["user_metrics"] = _sql("SELECT * FROM um", UM_AB, doubles=["ctr"])
    q["global_ctr"] = _sql(
        "SELECT exp_group, count(*) AS users, CAST(sum(likes) AS BIGINT) AS likes, "
        "CAST(sum(views) AS BIGINT) AS views, CAST(count_if(ctr IS NULL) AS BIGINT) AS n_undefined, "
        "CAST(sum(likes) AS DOUBLE) / NULLIF(sum(views), 0) AS global_ctr FROM um GROUP BY exp_group",
        UM_AB, doubles=["global_ctr"])
    q["smoothed_ctr"] = _sql("SELECT * FROM sm_ctr", UM_AB, *_smoothed_cte(), doubles=["ctr", "smoothed_ctr"])
    q["linearized_likes"] = _sql(
        "SELECT exp_group, user_id, likes, views, likes - (SELECT CAST(sum(likes) AS DOUBLE) / NULLIF(sum(views), 0) "
        "FROM um WHERE exp_group = 0) * views AS linearized_likes FROM um",
        _um_cte("um", (0, 3), c.AB_LO, c.AB_HI), doubles=["linearized_likes"])
    q["welch_stats_raw"] = _sql(_welch_select("um", "ctr", c.AB_A, c.AB_B), UM_AB, doubles=WELCH_DOUBLES)
    q["welch_stats_smoothed"] = _sql(_welch_select("sm_ctr", "smoothed_ctr", c.AB_A, c.AB_B), UM_AB,
                                     *_smoothed_cte(), doubles=WELCH_DOUBLES)
    lin_parts, lin_ctes = [], []
    for name, a, b in c.LIN_EXPERIMENTS:
        ctl = c.LIN_CONTROL[name]
        src = f"u_{a}{b}"
        lin_ctes.append(_um_cte(src, (a, b), c.AB_LO, c.AB_HI))
        lin_ctes.append(f"l_{a}{b} AS (SELECT exp_group, likes - (SELECT CAST(sum(likes) AS DOUBLE) / "
                        f"NULLIF(sum(views), 0) FROM {src} WHERE exp_group = {ctl}) * views AS linearized_likes "
                        f"FROM {src})")
        lin_parts.append(_welch_select(f"l_{a}{b}", "linearized_likes", a, b, extra=f"'{name}' AS experiment, "))
    q["welch_stats_linearized"] = _sql(" UNION ALL ".join(lin_parts), *lin_ctes, doubles=WELCH_DOUBLES)
    q["welch_stats_bucket"] = _sql(_welch_select("bm", "bucket_ctr", c.AB_A, c.AB_B), UM_AB, *BUCKET_CTE,
                                   doubles=WELCH_DOUBLES)
    q["mann_whitney_stats_raw"] = _sql(MW_SELECT, UM_AB, *_mw_ctes("um", "ctr", c.AB_A, c.AB_B), doubles=MW_DOUBLES)
    q["mann_whitney_stats_bucket"] = _sql(MW_SELECT, UM_AB, *BUCKET_CTE,
                                          *_mw_ctes("bm", "bucket_ctr", c.AB_A, c.AB_B), doubles=MW_DOUBLES)
    q["prob_superiority"] = _sql(
        "SELECT n_a, n_b, a_gt / (n_a * n_b) AS p_a_gt_b, ties / (n_a * n_b) AS p_tie, a_lt / (n_a * n_b) AS p_a_lt_b, n_undefined FROM rs",
        UM_AB, *_mw_ctes("um", "ctr", c.AB_A, c.AB_B), doubles=["p_a_gt_b", "p_tie", "p_a_lt_b"])
    q["bucket_metrics"] = _sql("SELECT * FROM bm", UM_AB, *BUCKET_CTE, doubles=["bucket_ctr", "ctr9"])
    # bins by their edges; every group has all of them
    nb = c.HIST_BINS

    def hist(src: str, value: str, lo: str, hi: str, by: str = "") -> str:
        keys, same = (f"{by}, ", f"AND b.{by} = s.{by}") if by else ("", "")
        groups = f"(SELECT DISTINCT {by} FROM {src} WHERE {value} IS NOT NULL) g, " if by else ""
        last = f"(b.bin = {nb - 1} AND s.{value} = b.hi)"
        return (f"SELECT {'b.' + by + ', ' if by else ''}b.bin, b.bin_lo, b.bin_hi, count(s.{value}) AS n FROM (SELECT {keys}CAST(i AS INTEGER) AS bin, lo, hi, "
                f"lo + i * (hi - lo) / {nb} AS bin_lo, lo + (i + 1) * (hi - lo) / {nb} AS bin_hi FROM {groups}range({nb}) r(i), "
                f"(SELECT {lo} AS lo, {hi} AS hi FROM {src}) e) b LEFT JOIN {src} s ON ((floor((s.{value} - b.lo) / (b.hi - b.lo) * {nb}) = b.bin) OR {last}) {same} "
                "GROUP BY ALL")

    q["ctr_histogram"] = _sql(hist("um", "ctr", "min(ctr)", "max(ctr)", "exp_group"), UM_AB, doubles=["bin_lo", "bin_hi"])
    q["bootstrap_replicates"] = _sql("SELECT * FROM bd", UM_AB, *BOOT_CTES, doubles=["ctr_a", "ctr_b", "diff"])
    q["bootstrap_summary"] = _sql(
        "SELECT * FROM bs", UM_AB, *BOOT_CTES,
        doubles=["mean_diff", "min_diff", "max_diff", "p025", "p975", "share_positive", "p_value"])
    q["bootstrap_histogram"] = _sql(hist("bd", "diff", "min(diff)", "max(diff)"), UM_AB, *BOOT_CTES, doubles=["bin_lo", "bin_hi"])
    q["aa_subsample_stats"] = _sql(_welch_select_grouped(), *AA_CTES, doubles=WELCH_DOUBLES)
    aa_p = (*AA_CTES, f"ws AS (SELECT *, iter AS rid FROM ({_welch_select_grouped()}) w0)", f"ap AS ({_t_tail('ws')})")
    q["aa_summary"] = _sql(
        "SELECT count(*) AS n_iter, CAST(count_if(p_value < 0.05) AS BIGINT) AS n_significant, "
        "count_if(p_value < 0.05) / count(*) AS false_positive_rate, avg(p_value) AS mean_p FROM ap",
        *aa_p, doubles=["false_positive_rate", "mean_p"])
    q["aa_pvalue_histogram"] = _sql(hist("ap", "p_value", "any_value(0.0)", "any_value(1.0)"), *aa_p, doubles=["bin_lo", "bin_hi"])
    q["prob_superiority_sampled"] = _sql(
        "SELECT count(*) AS n_pairs, avg(CASE WHEN va > vb THEN 1.0 ELSE 0.0 END) AS p_a_gt_b, "
        "avg(CASE WHEN va = vb THEN 1.0 ELSE 0.0 END) AS p_tie, "
        "avg(CASE WHEN va < vb THEN 1.0 ELSE 0.0 END) AS p_a_lt_b FROM "
        f"(SELECT iter, max(CASE WHEN exp_group = {c.AB_A} THEN ctr END) AS va, "
        f"max(CASE WHEN exp_group = {c.AB_B} THEN ctr END) AS vb FROM sel GROUP BY iter) p",
        UM_AB, *_draw_ctes("um", c.N_PAIRS, 1), doubles=["p_a_gt_b", "p_tie", "p_a_lt_b"])
    q["welch_stats_raw_pairs"] = _sql(
        " UNION ALL ".join(_welch_select(f"u_{a}{b}", "ctr", a, b, extra=f"'{name}' AS experiment, ") for name, a, b in c.LIN_EXPERIMENTS),
        *[_um_cte(f"u_{a}{b}", (a, b), c.AB_LO, c.AB_HI) for _, a, b in c.LIN_EXPERIMENTS], doubles=WELCH_DOUBLES)
    q["ab_summary"] = _ab_summary()
    q["stream_slot_metrics"] = _sql(
        f"SELECT * FROM slots WHERE {STREAM_CLOSED}",
        *(ct.replace(f"WHERE {SLOT_WHERE} ", "") for ct in SLOT_CTES), doubles=["CTR"])
    scan = ("SELECT '{kind}' AS kind, '{how}' AS how, CAST(time AS DATE) AS day, count(*) AS n, "
            "count(DISTINCT user_id) AS users FROM {table} GROUP BY 3")
    q["feed_scan"] = _sql(" UNION ALL ".join(
        scan.format(kind=kind, how=how, table=table) for kind, table in (("feed", "feed_actions"), ("messages", "message_actions"))
        for how in ("path", "name")))
    first_day = Y - dt.timedelta(days=2)
    left_alone = _cube("reference").replace(D(Y), D(first_day))
    only_ios = _cube("reference").replace("FROM feed_actions WHERE", "FROM feed_actions WHERE os = 'iOS' AND")
    q["cube_rewrite"] = f"SELECT * FROM ({left_alone}) a UNION ALL SELECT * FROM ({only_ios}) b"
    from feedlens.plans.maintained_oracle import maintained_sql   # builds on this module
    return q | maintained_sql(q)
