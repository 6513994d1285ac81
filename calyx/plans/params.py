"""Run dates used by the registered queries, and their calendar bounds
computed in plain Python (used by the oracle SQL, an independent check of
the Column expressions)."""

from __future__ import annotations

import datetime as dt

DS = "2024-01-10"          # a Wednesday: week 2024-01-08 .. 2024-01-14
DS_NEXT_WEEK = "2024-01-17"  # previous week of this date = 2024-01-08 .. 2024-01-14
DS_MONTH = "2024-01-20"     # month 2024-01, month-to-date snapshot to 01-20
DS_ORDERS = "1996-06-14"    # purchases day
DS_CAFE = "1997-03-15"      # café day
DS_SALES = "2000-01-01"     # sales since


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def week_start(s: str) -> dt.date:
    x = d(s)
    return x - dt.timedelta(days=x.weekday())


def plus(x, n: int) -> dt.date:
    return (d(x) if isinstance(x, str) else x) + dt.timedelta(days=n)


def month_start(s: str) -> dt.date:
    return d(s).replace(day=1)


def next_month(s: str) -> dt.date:
    m = month_start(s)
    return (m.replace(year=m.year + 1, month=1) if m.month == 12
            else m.replace(month=m.month + 1))
