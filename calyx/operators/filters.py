"""Period filters F1–F15.

All period filters become half-open ranges ``start <= c < end`` on the raw
column, so Parquet min/max statistics and row-group skipping apply
(``PushedFilters`` in the plan).  Non-sargable forms of the reference
(``c::date = ds``, ``to_char(c) = ds``, mixed forms) are rewritten to the
same range by these helpers rather than written as casts of the column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import calendar as cal


def _bound(df: DataFrame, col: str, d: Column) -> Column:
    """Cast a DATE bound to the type of ``df[col]`` (NTZ, LTZ or DATE)."""
    dt = df.schema[col].dataType
    if isinstance(dt, T.TimestampNTZType):
        return d.cast("timestamp_ntz")
    if isinstance(dt, T.TimestampType):
        return d.cast("timestamp")
    return d.cast("date")


def in_range(df: DataFrame, col: str, start, end) -> DataFrame:
    """``start <= col < end`` with DATE bounds (columns or literals)."""
    s, e = _bound(df, col, cal.as_date(start)), _bound(df, col, cal.as_date(end))
    return df.filter((F.col(col) >= s) & (F.col(col) < e))


def in_period(df: DataFrame, kind: str, ds, col: str = "created_at") -> DataFrame:
    start, end = cal.period_bounds(kind, ds)
    return in_range(df, col, start, end)


# F1 (also F5, F6, F14 — the same set of rows)
def filter_day(df: DataFrame, ds, col: str = "created_at") -> DataFrame:
    return in_period(df, "day", ds, col)


# F2
def filter_rolling_week(df: DataFrame, ds, col: str = "created_at") -> DataFrame:
    return in_period(df, "rolling_week", ds, col)


# F3
def filter_calendar_week(df: DataFrame, ds, col: str = "created_at") -> DataFrame:
    return in_period(df, "week", ds, col)


def filter_prev_week(df: DataFrame, ds, col: str = "created_at") -> DataFrame:
    return in_period(df, "prev_week", ds, col)


# F4
def filter_calendar_month(df: DataFrame, ds, col: str = "created_at") -> DataFrame:
    return in_period(df, "month", ds, col)


# F12 — closed range to 23:59:59 of the week's Sunday (drops its last fraction of a second)
def filter_week_closed_second(df: DataFrame, ds, col: str = "created_at") -> DataFrame:
    s = _bound(df, col, cal.week_start(ds))
    e = _bound(df, col, F.date_add(cal.week_start(ds), 7)) - F.expr("INTERVAL 1 SECOND")
    return df.filter((F.col(col) >= s) & (F.col(col) <= e))


# F13 — created_at <= month_end at midnight (drops the month's last day)
def filter_month_closed_midnight(df: DataFrame, ds, col: str = "created_at") -> DataFrame:
    s = _bound(df, col, cal.month_start(ds))
    e = _bound(df, col, cal.month_end(ds))
    return df.filter((F.col(col) >= s) & (F.col(col) <= e))


# F7 — equality on stamp / partition columns (partition pruning)
def filter_stamp(df: DataFrame, **stamps) -> DataFrame:
    cond = F.lit(True)
    for c, v in stamps.items():
        cond = cond & (F.col(c) == F.lit(v).cast(df.schema[c].dataType))
    return df.filter(cond)


# F9 — open-ended, col >= ds
def filter_since(df: DataFrame, ds, col: str) -> DataFrame:
    return df.filter(F.col(col) >= _bound(df, col, cal.as_date(ds)))


# F11 — history before a date, col < ds
def filter_before(df: DataFrame, ds, col: str = "created_at") -> DataFrame:
    return df.filter(F.col(col) < _bound(df, col, cal.as_date(ds)))


# F10
def filter_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull())
