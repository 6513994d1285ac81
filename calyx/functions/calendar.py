"""Calendar functions (D1–D9) as Column expressions.

Every function takes and returns Columns, so the same code stamps periods on
rows (per-row, vectorised in codegen) and builds filter bounds from a run date
``ds`` (a literal, which Catalyst folds into a constant that reaches the
Parquet scan as a pushed filter).  Weeks start on Monday.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(d) -> Column:
    """A DATE column from a column, a 'YYYY-MM-DD' string or a date."""
    if isinstance(d, Column):
        return d.cast("date")
    if isinstance(d, (_dt.date, _dt.datetime)):
        d = d.strftime("%Y-%m-%d")
    return F.lit(d).cast("date")


# D1 — current week, Monday .. Sunday
def week_start(d) -> Column:
    d = as_date(d)
    return F.date_sub(d, F.weekday(d))


def week_end(d) -> Column:
    return F.date_add(week_start(d), 6)


# D2 — previous week
def prev_week_start(d) -> Column:
    return F.date_sub(week_start(d), 7)


def prev_week_end(d) -> Column:
    return F.date_sub(week_start(d), 1)


# D3 — month first and last day
def month_start(d) -> Column:
    return F.trunc(as_date(d), "MM")


def month_end(d) -> Column:
    return F.last_day(as_date(d))


# D4 — month end exclusive: first day of the next month
def month_end_exclusive(d) -> Column:
    return F.add_months(month_start(d), 1)


# D5 — month labels
def month_name(d) -> Column:
    """Lower-case English month name, e.g. 'january'."""
    return F.lower(F.date_format(as_date(d), "MMMM"))


def year_month(d) -> Column:
    """'YYYY-MM' label."""
    return F.date_format(as_date(d), "yyyy-MM")


def month_tag(d) -> Column:
    """'MONYYYY' tag, e.g. 'JAN2024'."""
    d = as_date(d)
    return F.concat(F.upper(F.date_format(d, "MMM")), F.year(d).cast("string"))


def range_label(start, end) -> Column:
    """'YYYY-MM-DD-YYYY-MM-DD' label of an inclusive date range."""
    return F.concat_ws("-", F.date_format(as_date(start), "yyyy-MM-dd"),
                       F.date_format(as_date(end), "yyyy-MM-dd"))


# D6 — ds + n days
def shift_days(d, n: int) -> Column:
    return F.date_add(as_date(d), n)


# Period kinds understood by filters, back-fills and the spec runner.
# Each maps a date to its [start, end) half-open bounds.
PERIOD_KINDS = ("day", "rolling_week", "week", "prev_week", "month")


def period_bounds(kind: str, d) -> tuple[Column, Column]:
    """Half-open [start, end) DATE bounds of the period of ``kind`` holding ``d``."""
    d = as_date(d)
    if kind == "day":
        return d, F.date_add(d, 1)
    if kind == "rolling_week":
        return d, F.date_add(d, 7)
    if kind == "week":
        return week_start(d), F.date_add(week_start(d), 7)
    if kind == "prev_week":
        return prev_week_start(d), week_start(d)
    if kind == "month":
        return month_start(d), month_end_exclusive(d)
    raise ValueError(f"unknown period kind {kind!r}; expected one of {PERIOD_KINDS}")


def period_key(kind: str, ts) -> Column:
    """The start date of the period holding timestamp/date column ``ts``.

    Used by back-fills (D9): grouping by this key runs every period of a
    range in one job instead of one job per period.
    """
    d = ts.cast("date") if isinstance(ts, Column) else as_date(ts)
    if kind == "day":
        return d
    if kind == "week":
        return week_start(d)
    if kind == "month":
        return month_start(d)
    raise ValueError(f"period_key supports day/week/month, not {kind!r}")


# D8 — run-day rules, as predicates on a date column
def is_run_day(d, days_of_month=(), weekdays=()) -> Column:
    """True on the listed days of month (1..31) or weekdays (Mon=0 .. Sun=6)."""
    d = as_date(d)
    cond = F.lit(False)
    if days_of_month:
        cond = cond | F.dayofmonth(d).isin(list(days_of_month))
    if weekdays:
        cond = cond | F.weekday(d).isin(list(weekdays))
    return cond


def date_spine(bounds_df, start_col: str = "start", end_col: str = "end",
               out_col: str = "d"):
    """Explode each row's inclusive [start, end] into one row per date.

    ``bounds_df`` is normally one row (min/max of the data); the spine is
    produced by a generator on the executors, never collected.
    """
    return bounds_df.select(
        F.explode(F.sequence(F.col(start_col).cast("date"), F.col(end_col).cast("date"),
                             F.expr("INTERVAL 1 DAY"))).alias(out_col))
