"""Row filters (P1-P5). All become literal ranges/IN-lists that Catalyst pushes
into the parquet scan, so only the needed row groups are read."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlens.functions.columns import floor_slot, time_range, to_day, to_ts, ts_literal
from feedlens.sources.schema import PARTITION_DATE

ONE_DAY = dt.timedelta(days=1)


def _prune(df: DataFrame, lo: dt.date | None, hi: dt.date | None) -> DataFrame:
    """Add the same day range on the date partition column, if the input has one."""
    if PARTITION_DATE not in df.columns:
        return df
    c = F.col(PARTITION_DATE)
    if lo is not None:
        df = df.filter(c >= F.lit(lo))
    if hi is not None:
        df = df.filter(c <= F.lit(hi))
    return df


def between_dates(df: DataFrame, lo, hi, time_col: str = "time") -> DataFrame:
    """Closed date range lo..hi on the date of ``time_col`` (written as a ts range)."""
    lo, hi = to_day(lo), to_day(hi)
    return _prune(df.filter(time_range(df, to_ts(lo), to_ts(hi + ONE_DAY), time_col)), lo, hi)


def on_day(df: DataFrame, d, time_col: str = "time") -> DataFrame:
    """Rows of one day."""
    return between_dates(df, d, d, time_col)


def last_days(df: DataFrame, run_date, days: int, time_col: str = "time") -> DataFrame:
    """The ``days`` days ending with run_date, inclusive."""
    run_date = to_day(run_date)
    return between_dates(df, run_date - dt.timedelta(days=days - 1), run_date, time_col)


def up_to_day(df: DataFrame, d, time_col: str = "time") -> DataFrame:
    """Everything up to and including day d (the history as of that day)."""
    d = to_day(d)
    t = df.schema[time_col].dataType
    return _prune(df.filter(F.col(time_col) < ts_literal(to_ts(d + ONE_DAY), t)), None, d)


def closed_slots_range(as_of, minutes: int = 15) -> tuple[dt.datetime, dt.datetime]:
    """[start of the day before as_of, start of as_of's slot)."""
    as_of = to_ts(as_of)
    lo = to_ts(as_of.date() - ONE_DAY)
    return lo, floor_slot(as_of, minutes)


def closed_slots(df: DataFrame, as_of, minutes: int = 15, time_col: str = "time") -> DataFrame:
    """Rows from the start of the day before ``as_of`` up to the start of its slot."""
    lo, hi = closed_slots_range(as_of, minutes)
    return _prune(df.filter(time_range(df, lo, hi, time_col)), lo.date(), hi.date())


def in_groups(df: DataFrame, groups, group_col: str = "exp_group") -> DataFrame:
    """Rows of the given experiment groups."""
    return df.filter(F.col(group_col).isin(list(groups)))
