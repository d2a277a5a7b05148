import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlens.operators import experiment as ex


def _vals(spark, a_vals, b_vals, col="x"):
    rows = [(1, i, float(v)) for i, v in enumerate(a_vals)] + \
           [(2, 1000 + i, float(v)) for i, v in enumerate(b_vals)]
    return spark.createDataFrame(rows, f"exp_group int, user_id long, {col} double")


A = [0.1, 0.4, 0.4, 0.2, 0.9, 0.5, 0.3]
B = [0.3, 0.4, 0.6, 0.7, 0.8, 0.4, 0.6, 1.0, 0.2]


def test_welch_golden_and_antisymmetry(spark):
    df = _vals(spark, A, B)
    r = ex.welch_stats(df, "x", 1, 2).collect()[0]
    a, b = np.array(A), np.array(B)
    va, vb = a.var(ddof=1) / len(a), b.var(ddof=1) / len(b)
    t = (a.mean() - b.mean()) / math.sqrt(va + vb)
    dof = (va + vb) ** 2 / (va ** 2 / (len(a) - 1) + vb ** 2 / (len(b) - 1))
    assert (r.n_a, r.n_b) == (7, 9)
    assert math.isclose(r.t, t, rel_tol=1e-12) and math.isclose(r.df, dof, rel_tol=1e-12)
    r2 = ex.welch_stats(df, "x", 2, 1).collect()[0]
    assert math.isclose(r2.t, -r.t, rel_tol=1e-12) and math.isclose(r2.df, r.df, rel_tol=1e-12)
    p = ex.welch_test(df, "x", 1, 2).collect()[0].p_value
    assert 0 < p < 1


def _brute_u(a, b):
    return sum((x > y) + 0.5 * (x == y) for x, y in itertools.product(a, b))


@pytest.mark.parametrize("seed", [1, 3])
def test_mann_whitney_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    a = [rnd.choice([0.0, 0.1, 0.25, 0.5, 1.0, rnd.random()]) for _ in range(40)]
    b = [rnd.choice([0.0, 0.2, 0.25, 0.5, rnd.random()]) for _ in range(33)]
    df = _vals(spark, a, b)
    r = ex.mann_whitney_stats(df, "x", 1, 2).collect()[0]
    assert r.u_a == _brute_u(a, b)
    assert r.u_a + r.u_b == len(a) * len(b)
    ties = sum(t ** 3 - t for t in
               [sum(1 for v in a + b if v == u) for u in set(a + b)])
    assert r.tie_term == ties
    n1, n2 = len(a), len(b)
    n = n1 + n2
    sigma = math.sqrt(n1 * n2 / 12 * ((n + 1) - ties / (n * (n - 1))))
    z = (max(r.u_a, r.u_b) - n1 * n2 / 2 - 0.5) / sigma
    assert math.isclose(r.z, z, rel_tol=1e-12)
    p = ex.prob_superiority(df, "x", 1, 2).collect()[0]
    gt = sum(x > y for x, y in itertools.product(a, b)) / (n1 * n2)
    tie = sum(x == y for x, y in itertools.product(a, b)) / (n1 * n2)
    assert math.isclose(p.p_a_gt_b, gt) and math.isclose(p.p_tie, tie)
    assert math.isclose(p.p_a_gt_b + p.p_tie + p.p_a_lt_b, 1.0)


def test_mann_whitney_pvalue_clipped_at_one(spark):
    df = _vals(spark, [1.0, 2.0, 3.0], [1.0, 2.0, 3.0])
    r = ex.mann_whitney(df, "x", 1, 2).collect()[0]
    assert r.p_value == 1.0 and r.method == "asymptotic"


def test_index_quantile_rule(spark):
    rows = [("g", float(v)) for v in range(1, 11)] + [("h", 5.0), ("h", None), ("e", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.quantile for r in ex.index_quantile(df, ["k"], "v", 0.9).collect()}
    # 0-based index floor(0.9 * 10) = 9 -> 10.0 (percentile_disc would give 9.0)
    assert got == {"g": 10.0, "h": 5.0}
    rnd = random.Random(4)
    vals = {k: [rnd.choice(range(40)) for _ in range(rnd.randint(1, 60))] for k in "abcdef"}
    df = spark.createDataFrame([(k, v) for k, vs in vals.items() for v in vs], "k string, v int")
    for q in (0.0, 0.5, 0.9, 1.0):
        got = {r.k: r.quantile for r in ex.index_quantile(df, ["k"], "v", q).collect()}
        want = {k: sorted(vs)[min(int(q * len(vs)), len(vs) - 1)] for k, vs in vals.items()}
        assert got == want, q


def test_smoothed_and_linearized(spark):
    rows = [(1, 1, 2, 10), (1, 2, 3, 0), (2, 3, 1, 4), (2, 4, 0, 6)]
    um = spark.createDataFrame(rows, "exp_group int, user_id long, likes long, views long") \
        .withColumn("ctr", F.try_divide(F.col("likes").cast("double"), F.col("views").cast("double")))
    sm = {r.user_id: r.smoothed_ctr for r in ex.smoothed_ctr(um, (1, 2), 5.0).collect()}
    g1, g2 = 5 / 10, 1 / 10
    assert math.isclose(sm[2], (3 + 5 * g1) / (0 + 5))     # zero-view user stays in (D2)
    assert math.isclose(sm[4], (0 + 5 * g2) / (6 + 5))
    lin = {r.user_id: r.linearized_likes for r in ex.linearized_likes(um, (1, 2), 1).collect()}
    assert math.isclose(lin[3], 1 - g1 * 4) and math.isclose(lin[1], 2 - g1 * 10)
    tot = {r.exp_group: r for r in ex.group_totals(um, (1, 2)).collect()}
    assert tot[1].n_undefined == 1 and tot[1].global_ctr == g1


def _users(spark, n_per_group=300, seed=1):
    rnd = random.Random(seed)
    rows = []
    for g in (2, 3):
        for i in range(n_per_group):
            views = rnd.randint(0, 30)
            likes = rnd.randint(0, 8)
            rows.append((g, g * 10000 + i, likes, views))
    return (spark.createDataFrame(rows, "exp_group int, user_id long, likes long, views long")
            .withColumn("ctr", F.try_divide(F.col("likes").cast("double"), F.col("views").cast("double"))))


def test_bootstrap_is_partition_invariant_and_sane(spark):
    um = _users(spark)
    r1 = {r.replicate: r for r in ex.bootstrap_replicates(um, 2, 3, 300, seed=7).collect()}
    r2 = {r.replicate: r for r in ex.bootstrap_replicates(um.repartition(13), 2, 3, 300, seed=7).collect()}
    assert r1.keys() == r2.keys() == set(range(300))
    assert all(r1[k].diff == r2[k].diff for k in r1)
    s = ex.bootstrap_summary(ex.bootstrap_replicates(um, 2, 3, 300, seed=7)).collect()[0]
    assert s.n_replicates == 300 and s.min_diff <= s.p025 <= s.mean_diff <= s.p975 <= s.max_diff


def test_identical_groups_have_bootstrap_p_of_one(spark):
    rows = [(g, 100 * g + i, 1, 4) for g in (2, 3) for i in range(40)]
    um = spark.createDataFrame(rows, "exp_group int, user_id long, likes long, views long")
    s = ex.bootstrap_summary(ex.bootstrap_replicates(um, 2, 3, 200)).first()
    assert (s.mean_diff, s.share_positive, s.p_value) == (0.0, 0.0, 1.0)


def test_a_changed_seed_changes_the_draws(spark):
    um = _users(spark, 60)
    for mode in ("md5", "xxhash64"):
        a, b = ([(r.replicate, r.diff) for r in ex.bootstrap_replicates(um, 2, 3, 50, seed, mode).orderBy("replicate").collect()] for seed in (0, 1))
        assert a != b
        a, b = (sorted((r.iter, r.user_id) for r in ex.aa_subsamples(um, 2, 3, 20, 5, seed, mode).collect()) for seed in (0, 1))
        assert a != b


@pytest.mark.parametrize("m", [1, 2, 17, 256])
def test_poisson_thresholds_are_the_distribution(m):
    from feedlens.operators.experiment.resample import U32, poisson_thresholds
    first, steps = poisson_thresholds(m)
    assert steps == sorted(steps) and 0 < steps[0] and steps[-1] < U32
    grid = (np.arange(200_000) + 0.5) / 200_000 * U32
    draws = first + np.searchsorted(np.array(steps), grid, side="right")
    assert abs(draws.mean() - m) < 0.01 * m and abs(draws.var() - m) < 0.02 * m


def test_collapsed_bootstrap_has_the_spread_of_the_plain_one(spark):
    um = _users(spark, 700)
    like = um.select("exp_group", "user_id", F.lit(1).alias("likes"), F.lit(2).alias("views"))   # 700 like users: three parts
    got = [r.num_a for r in ex.bootstrap_replicates(like, 2, 3, 600).collect()]
    assert abs(np.mean(got) - 700) < 5 and abs(np.var(got) - 700) < 140


def test_draws_are_distinct_uniform_and_partition_invariant(spark):
    um = _users(spark, 300)
    k, n_iter = 5, 2000
    key = lambda df: sorted((r.iter, r.exp_group, r.user_id) for r in df.collect())
    got = key(ex.aa_subsamples(um, 2, 3, n_iter, k, seed=11))
    assert len(got) == len(set(got)) == n_iter * 2 * k
    assert key(ex.aa_subsamples(um.repartition(7), 2, 3, n_iter, k, seed=11)) == got
    times = {}
    for _, _, u in got:
        times[u] = times.get(u, 0) + 1
    defined = [r.user_id for r in um.filter("ctr IS NOT NULL").collect()]
    assert set(times) == set(defined)
    n = len(defined) / 2
    chi = sum((times[u] - n_iter * k / n) ** 2 / (n_iter * k / n) for u in defined)
    assert abs(chi - 2 * n) < 6 * math.sqrt(4 * n)
    st = ex.aa_summary(ex.aa_stats(um, 2, 3, 400, k, seed=11)).collect()[0]
    assert st.n_iter == 400 and 0 <= st.false_positive_rate <= 1


def test_drawing_all_users_gives_all(spark):
    um = spark.createDataFrame([(g, 10 * g + i, 0.5) for g in (2, 3) for i in range(6)], "exp_group int, user_id long, ctr double")
    got = ex.aa_subsamples(um, 2, 3, 30, 6).collect()
    assert len({(r.iter, r.user_id) for r in got}) == len(got) == 30 * 12


def test_aa_raises_when_group_too_small(spark):
    with pytest.raises(Exception, match="cannot draw 25"):
        ex.aa_subsamples(_users(spark, 20), 2, 3, 10, 25).collect()


def test_many_distinct_values_rank_without_codegen_failure(spark):
    df = spark.range(20_000).select((F.col("id") % 2 + 1).cast("int").alias("exp_group"), F.col("id").alias("user_id"),
                                    ((F.col("id") * 7919 % 20_000) / 1e9 + 0.25).alias("x"))
    r = ex.mann_whitney_stats(df, "x", 1, 2).first()
    x = np.array([(i * 7919 % 20_000) for i in range(20_000)])
    a, b = np.sort(x[0::2]), np.sort(x[1::2])
    assert r.u_a == float(np.searchsorted(b, a).sum())
    wide = spark.createDataFrame([(1, -1e300), (1, 1e-300), (2, 0.0), (2, 1e300), (1, -5.0), (2, -5.0)], "exp_group int, x double")
    r = ex.mann_whitney_stats(wide, "x", 1, 2).first()
    assert r.u_a == _brute_u([-1e300, 1e-300, -5.0], [0.0, 1e300, -5.0])


def test_histogram_shared_bins(spark):
    df = _vals(spark, A, B)
    rows = ex.histogram(df, "x", "exp_group", 4).collect()
    assert sum(r.n for r in rows) == len(A) + len(B) and len(rows) == 8   # empty bins too
    lo, hi = min(A + B), max(A + B)
    for r in rows:
        assert 0 <= r.bin < 4
        assert math.isclose(r.bin_lo, lo + r.bin * (hi - lo) / 4)
    counts, _ = np.histogram(A, bins=4, range=(lo, hi))
    got = [0] * 4
    for r in rows:
        if r.exp_group == 1:
            got[r.bin] = r.n
    assert got == counts.tolist()


def test_sampled_prob_superiority_converges_to_exact(spark):
    um = _users(spark, 150)
    exact = ex.prob_superiority(um, "ctr", 2, 3).first()
    mc = ex.prob_superiority(um, "ctr", 2, 3, n_pairs=20000, seed=5).first()
    assert mc.n_pairs == 20000
    assert abs(mc.p_a_gt_b - exact.p_a_gt_b) < 0.02 and abs(mc.p_tie - exact.p_tie) < 0.02
    assert math.isclose(mc.p_a_gt_b + mc.p_tie + mc.p_a_lt_b, 1.0)


def test_ab_summary_parts_agree_with_single_tests(spark):
    from feedlens.plans.ab import ab_summary
    from feedlens.sources.fixtures import load_fixture
    from fixture_paths import SF001
    feed, _ = load_fixture(spark, SF001)
    rows = {(r.test, r.metric): r for r in ab_summary(feed, 1, 2, "2024-01-08", "2024-01-14",
                                                      n_boot=200).collect()}
    um = ex.user_metrics(feed, (1, 2), "2024-01-08", "2024-01-14")
    w = ex.welch_test(um, "ctr", 1, 2).first()
    assert math.isclose(rows[("welch_t", "ctr")].statistic, w.t, rel_tol=1e-12)
    assert math.isclose(rows[("welch_t", "ctr")].p_value, w.p_value, rel_tol=1e-9)
    lin = ex.welch_test(ex.linearized_likes(um, (1, 2), 1), "linearized_likes", 1, 2).first()
    assert math.isclose(rows[("welch_t", "linearized_likes")].statistic, lin.t, rel_tol=1e-9)
    sm = ex.welch_test(ex.smoothed_ctr(um, (1, 2), 5.0), "smoothed_ctr", 1, 2).first()
    assert math.isclose(rows[("welch_t", "smoothed_ctr_alpha_5")].statistic, sm.t, rel_tol=1e-9)
    mw = ex.mann_whitney(um, "ctr", 1, 2).first()
    assert rows[("mann_whitney", "ctr")].statistic == mw.u_a
    assert math.isclose(rows[("mann_whitney", "ctr")].p_value, mw.p_value, rel_tol=1e-12)
    ps = ex.prob_superiority(um, "ctr", 1, 2).first()
    assert math.isclose(rows[("prob_a_gt_b", "ctr")].statistic, ps.p_a_gt_b, rel_tol=1e-12)
    assert len(rows) == 8


def test_draws_stay_near_k_for_every_k(spark):
    """The tries of an iteration and group, for all k up to n, and exact samples near n."""
    from feedlens.operators.experiment.draws import draws_needed
    n = 1000
    rows = spark.range(1, n + 1).select(F.col("id").alias("k"), draws_needed(F.least("id", n - F.col("id")), F.lit(n)).alias("tries")).collect()
    assert all(r.tries <= 2.5 * r.k + 47 for r in rows) and rows[-1].tries == 0 and rows[0].tries == 1
    um = spark.range(400).select(F.col("id").alias("user_id"), (F.col("id") % 2).cast("int").alias("exp_group"), (F.col("id") * 1.0).alias("ctr"))
    for k in (100, 101, 150, 199, 200):
        got = ex.aa_subsamples(um, 0, 1, 40, k).groupBy("iter", "exp_group").agg(
            F.count("*").alias("n"), F.count_distinct("user_id").alias("d"), F.avg("ctr").alias("m")).collect()
        assert len(got) == 80 and all(r.n == r.d == k for r in got)
        assert abs(sum(r.m for r in got) / 80 - 199.5) < 15
        assert len({r.m for r in got}) > 30 or k >= 199
    same = [sorted(map(tuple, ex.aa_subsamples(um.repartition(p), 0, 1, 5, 180).collect())) for p in (1, 9)]
    assert same[0] == same[1]
