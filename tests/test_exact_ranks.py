import itertools
import math

import pytest

from feedlens.functions.pvalue import exact_u_two_sided, u_arrangements
from feedlens.operators import experiment as ex


def by_enumeration(m, n, u):
    """All orders of the values: two-sided p of U = u."""
    far = max(u, m * n - u)
    hits = total = 0
    for places in itertools.combinations(range(m + n), m):
        value = sum(places) - m * (m - 1) // 2
        total += 1
        hits += value >= far
    return min(1.0, 2 * hits / total)


@pytest.mark.parametrize("m, n", [(1, 1), (1, 8), (2, 5), (3, 3), (5, 4), (8, 8), (7, 8), (4, 12)])
def test_equals_full_enumeration(m, n):
    for u in range(m * n + 1):
        assert exact_u_two_sided(m, n, u) == pytest.approx(by_enumeration(m, n, u), rel=1e-14)
    assert sum(u_arrangements(m, n, m * n)) == math.comb(m + n, m)


def test_large_partner_and_symmetry():
    counts = u_arrangements(8, 3000, 24000)
    assert sum(counts) == math.comb(3008, 8) and counts == counts[::-1]
    assert u_arrangements(3000, 8, 100) == counts[:101]


def frame(spark, a, b):
    return spark.createDataFrame([(1, k, float(v)) for k, v in enumerate(a)] + [(2, k, float(v)) for k, v in enumerate(b)],
                                 "exp_group int, user_id long, ctr double")


@pytest.mark.parametrize("a, b, method", [
    ([1, 5, 9, 11], [2, 3, 4, 6, 7, 8, 10], "exact"),
    ([1, 5, 9, 11], [1, 3, 4, 6, 7, 8, 10], "asymptotic"),                     # a tie
    (list(range(0, 18, 2)), list(range(1, 19, 2)), "asymptotic"),              # nine each
    (list(range(0, 16, 2)), list(range(100, 160)), "exact"),
])
def test_method_and_value(spark, a, b, method):
    r = ex.mann_whitney(frame(spark, a, b), "ctr", 1, 2).first()
    assert r.method == method
    u = sum((x > y) + (x == y) / 2 for x in a for y in b)
    assert r.u_a == u
    if method == "exact":
        assert r.p_value == pytest.approx(exact_u_two_sided(len(a), len(b), u))
        assert ex.rank_summary(frame(spark, a, b), "ctr", 1, 2).first().p_value == r.p_value
    else:
        assert r.p_value == pytest.approx(math.erfc(abs(r.z) / math.sqrt(2)) if r.z >= 0 else 1.0)


def test_empty_group_has_no_value(spark):
    r = ex.mann_whitney(frame(spark, [1, 2], []), "ctr", 1, 2).first()
    assert r.p_value is None or math.isnan(r.p_value)
