"""Randomised properties on small lists (hypothesis drives the inputs)."""

import itertools
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from feedlens.operators import experiment as ex

VALS = st.lists(st.sampled_from([0.0, 0.1, 0.2, 0.25, 0.5, 0.75, 1.0, 1.5]), min_size=2, max_size=25)
SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _df(spark, a, b):
    rows = [(1, i, float(v)) for i, v in enumerate(a)] + [(2, 100 + i, float(v)) for i, v in enumerate(b)]
    return spark.createDataFrame(rows, "exp_group int, user_id long, x double")


@SETTINGS
@given(a=VALS, b=VALS)
def test_rank_statistics_properties(spark, a, b):
    df = _df(spark, a, b)
    r = ex.mann_whitney_stats(df, "x", 1, 2).first()
    brute = sum((x > y) + 0.5 * (x == y) for x, y in itertools.product(a, b))
    assert r.u_a == brute and r.u_a + r.u_b == len(a) * len(b)
    p = ex.prob_superiority(df, "x", 1, 2).first()
    q = ex.prob_superiority(df, "x", 2, 1).first()
    assert math.isclose(p.p_a_gt_b, q.p_a_lt_b, abs_tol=1e-12)
    assert math.isclose(p.p_tie, q.p_tie, abs_tol=1e-12)


@SETTINGS
@given(a=VALS, b=VALS)
def test_welch_antisymmetric(spark, a, b):
    df = _df(spark, a, b)
    r1 = ex.welch_stats(df, "x", 1, 2).first()
    r2 = ex.welch_stats(df, "x", 2, 1).first()
    if r1.t is None:
        assert r2.t is None
    else:
        assert math.isclose(r1.t, -r2.t, rel_tol=1e-12, abs_tol=1e-12)
        assert math.isclose(r1.df, r2.df, rel_tol=1e-12)
