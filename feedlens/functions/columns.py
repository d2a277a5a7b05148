"""Scalar column helpers shared by all operators (all JVM-side expressions)."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c) -> Column:
    """A column from a name or a Column."""
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- ratios
def ratio(num, den) -> Column:
    """num / den as double; NULL when den is 0 or NULL (never inf/NaN)."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


# ---------------------------------------------------------------- dates/times
def to_day(d) -> dt.date:
    """A date from a date, datetime or ISO string."""
    if isinstance(d, dt.datetime):
        return d.date()
    if isinstance(d, dt.date):
        return d
    return dt.date.fromisoformat(str(d))


def to_ts(t) -> dt.datetime:
    """A datetime from a datetime, date or ISO string."""
    if isinstance(t, dt.datetime):
        return t
    if isinstance(t, dt.date):
        return dt.datetime(t.year, t.month, t.day)
    return dt.datetime.fromisoformat(str(t))


def ts_literal(value: dt.datetime, like: T.DataType) -> Column:
    """A timestamp literal of the same type as the column it is compared with.

    A string cast keeps the wall-clock value for NTZ columns whatever the session
    time zone, and the comparison stays a plain literal range that reaches the
    parquet reader as PushedFilters.
    """
    target = "timestamp" if isinstance(like, T.TimestampType) else "timestamp_ntz"
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast(target)


def time_range(df: DataFrame, lo: dt.datetime, hi: dt.datetime, time_col: str = "time") -> Column:
    """Half-open [lo, hi) predicate on a timestamp column."""
    t = df.schema[time_col].dataType
    return (F.col(time_col) >= ts_literal(lo, t)) & (F.col(time_col) < ts_literal(hi, t))


def day_of(time_col: str = "time") -> Column:
    """Date of a timestamp column."""
    return F.to_date(F.col(time_col))


def slot_start(time_col: str = "time", minutes: int = 15) -> Column:
    """Floor to an N-minute slot; keeps the column's timestamp type (NTZ stays NTZ)."""
    return F.window(F.col(time_col), f"{minutes} minutes").start


def floor_slot(t: dt.datetime, minutes: int = 15) -> dt.datetime:
    """Start of the N-minute slot containing a Python datetime."""
    m = (t.hour * 60 + t.minute) // minutes * minutes
    return dt.datetime(t.year, t.month, t.day, m // 60, m % 60)


def week_start(d) -> Column:
    """Monday of the ISO week of a date column (stays DateType)."""
    d = col(d)
    return F.date_sub(d, F.pmod(F.dayofweek(d) + 5, F.lit(7)))


def monday(d: dt.date) -> dt.date:
    """Monday of a Python date's ISO week."""
    return d - dt.timedelta(days=d.weekday())


def hm(ts) -> Column:
    """HH:mm of a timestamp column."""
    return F.date_format(col(ts), "HH:mm")


# ---------------------------------------------------------------- labels
# Age bins as (exclusive lower bound, inclusive upper bound, label);
# anything else, NULL included, is '41+'. The 'reference' preset keeps the source
# job's gap at exactly 31 (falls through to '41+'); 'fixed' closes it.
AGE_BINS = {
    "reference": [(None, 20, "0 - 20"), (20, 30, "21-30"), (31, 40, "31-40")],
    "fixed": [(None, 20, "0 - 20"), (20, 30, "21-30"), (30, 40, "31-40")],
}
AGE_OTHER = "41+"


def age_group(age="age", bins="fixed") -> Column:
    """Age label from a bin preset ('fixed' or 'reference') or a list of (lo, hi, label)."""
    spec = AGE_BINS[bins] if isinstance(bins, str) else bins
    a = col(age)
    expr = None
    for lo, hi, label in spec:
        cond = a <= hi if lo is None else (a > lo) & (a <= hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(AGE_OTHER)


def gender_label(gender="gender") -> Column:
    """1 -> 'male', anything else (NULL included) -> 'female'."""
    return F.when(col(gender) == 1, "male").otherwise("female")


# ---------------------------------------------------------------- hashing
U32 = 4294967296  # 2**32


def md5_u32(*parts) -> Column:
    """Portable 32-bit hash: first 8 hex digits of md5 of the '-'-joined parts.

    Computable identically in other SQL engines, used where results are checked
    against an oracle.
    """
    key = F.concat_ws("-", *[col(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


def xx_u32(*parts, seed: int = 0) -> Column:
    """Fast 32-bit hash in [0, 2^32) from xxhash64 of the parts and a seed."""
    return F.pmod(F.xxhash64(*[col(p) for p in parts], F.lit(seed)), F.lit(U32))


def hash_u32(*parts, mode: str = "xxhash64", seed: int = 0) -> Column:
    """32-bit hash of the parts: 'xxhash64' (seeded) or portable 'md5'."""
    if mode == "md5":
        return md5_u32(*parts)
    if mode == "xxhash64":
        return xx_u32(*parts, seed=seed)
    raise ValueError(f"unknown hash mode {mode!r}")


def bucket_of(key, n: int, mode: str = "xxhash64") -> Column:
    """Hash bucket in [0, n) (non-negative: pmod, not %)."""
    if mode == "md5":
        return F.pmod(md5_u32(key), F.lit(n))
    return F.pmod(F.xxhash64(col(key)), F.lit(n))


# ---------------------------------------------------------------- output helpers
def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double column (for engine-independent comparison).

    Values are first snapped to a 1e-9 grid, so that results differing only by
    summation order (and sitting on an exact decimal tie such as 0.2680625) become
    the same double; then round(x * 10^p) / 10^p rounds that binary value (as other
    engines do; Spark's round(x, p) rounds the shortest decimal form), and + 0.0
    turns -0.0 into 0.0.
    """
    scale = float(10 ** places)
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            x = F.col(f.name).cast("double")
            snapped = F.round(x * 1e9) / 1e9
            cols.append((F.round(snapped * scale) / scale + F.lit(0.0)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
