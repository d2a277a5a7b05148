"""Two-sided p-values for Welch's t, the normal approximation and the exact U distribution.

The heavy part of every test is a Spark aggregate producing one row per
comparison (or per A/A iteration); only these tails run in Python, as
Arrow-batched pandas UDFs over those rows. The regularised incomplete beta uses
the classic continued fraction (modified Lentz), vectorised with numpy.
"""

from __future__ import annotations

import math
import sys
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ship this module's code with the UDFs (pickle by value), so Python workers need
# only numpy/pandas, not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

def _elementwise(fn, x) -> np.ndarray:
    # plain functions (not np.vectorize objects) so the module pickles by value
    x = np.asarray(x, dtype=float)
    return np.fromiter((fn(v) for v in x.ravel()), dtype=float, count=x.size).reshape(x.shape)


def _lgamma(x) -> np.ndarray:
    return _elementwise(math.lgamma, x)


def _erfc(x) -> np.ndarray:
    return _elementwise(math.erfc, x)


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray, tolerance: float = 1e-15, deepest: int = 1 << 17):
    """1 / (1 + d1 / (1 + d2 / (1 + ...))) of the incomplete beta function (DLMF 8.17.22):
    d(2m) = m (b-m) x / ((a+2m-1)(a+2m)), d(2m+1) = -(a+m)(a+b+m) x / ((a+2m)(a+2m+1)).

    Evaluated from the inside out at twice the depth each time, until two depths agree;
    NaN where they never do."""
    def at_depth(depth: int) -> np.ndarray:
        inner = np.ones_like(x)
        for j in range(depth, 0, -1):
            m, odd = divmod(j, 2)
            term = -(a + m) * (a + b + m) / (a + 2 * m + 1) if odd else m * (b - m) / (a + 2 * m - 1)
            inner = 1.0 + term * x / ((a + 2 * m) * inner)
        return 1.0 / inner

    depth, value = 32, at_depth(16)
    while depth <= deepest:
        before, value = value, at_depth(depth)
        if np.all(np.abs(value - before) <= tolerance * np.abs(value)):
            return value
        depth *= 2
    return np.where(np.abs(value - before) <= 1e-12 * np.abs(value), value, np.nan)


def betainc(a, b, x) -> np.ndarray:
    """Regularised incomplete beta I_x(a, b), elementwise; NaN where undefined."""
    a, b, x = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(a, b, x))
    out = np.full(x.shape, np.nan)
    ok = np.isfinite(a) & np.isfinite(b) & np.isfinite(x) & (a > 0) & (b > 0) & (x >= 0) & (x <= 1)
    out[ok & (x == 0)] = 0.0
    out[ok & (x == 1)] = 1.0
    inner = ok & (x > 0) & (x < 1)
    if inner.any():
        ai, bi, xi = a[inner], b[inner], x[inner]
        log_front = (_lgamma(ai + bi) - _lgamma(ai) - _lgamma(bi)
                     + ai * np.log(xi) + bi * np.log1p(-xi))
        front = np.exp(log_front)
        direct = xi < (ai + 1.0) / (ai + bi + 2.0)
        res = np.empty_like(xi)
        if direct.any():
            res[direct] = front[direct] * _beta_fraction(ai[direct], bi[direct], xi[direct]) / ai[direct]
        flip = ~direct
        if flip.any():
            res[flip] = 1.0 - front[flip] * _beta_fraction(bi[flip], ai[flip], 1.0 - xi[flip]) / bi[flip]
        out[inner] = res
    return out


def t_two_sided(t, df) -> np.ndarray:
    """P(|T_df| >= |t|) = I_{df/(df+t^2)}(df/2, 1/2)."""
    t = np.asarray(t, dtype=float)
    df = np.asarray(df, dtype=float)
    with np.errstate(invalid="ignore", divide="ignore"):
        x = df / (df + t * t)
        p = betainc(df / 2.0, 0.5, x)
    p[~(np.isfinite(t) & np.isfinite(df) & (df > 0))] = np.nan
    return p


def norm_two_sided(z) -> np.ndarray:
    """P(|Z| >= |z|) for a standard normal."""
    z = np.asarray(z, dtype=float)
    out = np.full(z.shape, np.nan)
    ok = np.isfinite(z)
    out[ok] = _erfc(np.abs(z[ok]) / math.sqrt(2.0))
    return out


def u_arrangements(m: int, n: int, most: int) -> list[int]:
    """How many of the C(m + n, m) orders of m and n different values have U = 0, 1, ...,
    ``most``. U is a partition into at most m parts of at most n each, so the counts are
    the coefficients of prod (1 - q**(n + i)) / (1 - q**i), i = 1 to m; whole numbers."""
    m, n = min(m, n), max(m, n)
    counts = [1] + [0] * most
    for i in range(1, m + 1):
        for u in range(i, most + 1):
            counts[u] += counts[u - i]
        for u in range(most, n + i - 1, -1):
            counts[u] -= counts[u - n - i]
    return counts


def exact_u_two_sided(m: int, n: int, u: float) -> float:
    """P(U at least as far from m * n / 2 as u), twice the smaller tail, at most 1; for
    values without ties (u is whole)."""
    low = int(min(u, m * n - u))
    return min(1.0, float(Fraction(2 * sum(u_arrangements(m, n, low)), math.comb(m + n, m))))


@F.pandas_udf(T.DoubleType())
def _exact_u_udf(n_a: pd.Series, n_b: pd.Series, u_a: pd.Series) -> pd.Series:
    known = {}
    out = []
    for key in zip(n_a, n_b, u_a):
        if any(pd.isna(x) for x in key) or min(key[:2]) < 1:
            out.append(np.nan)
            continue
        if key not in known:
            known[key] = exact_u_two_sided(int(key[0]), int(key[1]), key[2])
        out.append(known[key])
    return pd.Series(out, dtype=float)


@F.pandas_udf(T.DoubleType())
def _t_pvalue_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(t_two_sided(t.to_numpy(dtype=float, na_value=np.nan),
                                 df.to_numpy(dtype=float, na_value=np.nan)))


@F.pandas_udf(T.DoubleType())
def _z_pvalue_udf(z: pd.Series) -> pd.Series:
    return pd.Series(norm_two_sided(z.to_numpy(dtype=float, na_value=np.nan)))


def t_pvalue(t: Column, df: Column) -> Column:
    """Column: two-sided Student-t p-value for (t, df)."""
    return _t_pvalue_udf(t, df)


def z_pvalue(z: Column) -> Column:
    """Column: two-sided standard-normal p-value for z."""
    return _z_pvalue_udf(z)


def exact_u_pvalue(n_a: Column, n_b: Column, u_a: Column) -> Column:
    """Column: exact two-sided Mann-Whitney p-value of U without ties."""
    return _exact_u_udf(n_a, n_b, u_a)
