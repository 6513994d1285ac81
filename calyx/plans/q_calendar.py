"""Registered calendar queries.

The calendar functions are applied to every distinct order date (1995–2001:
leap days, month and year ends) — the oracle computes the same bounds with
DuckDB's own date functions.  Back-fills run A1 for every period of the
events table in one job.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..operators import aggregates as A
from ..sources import tables as T
from .registry import ATTEMPTS, register, with_

DAYS = "days as (select distinct cast(o_orderdate as date) d from orders)"
WD = with_(DAYS)


def days(spark, sf):
    return T.read_table(spark, sf, "orders").select(
        F.col("o_orderdate").cast("date").alias("d")).distinct()


def on_days(*named):
    def run(spark, sf):
        d = F.col("d")
        return days(spark, sf).select("d", *[fn(d).alias(n) for n, fn in named])
    return run


WSD = "cast(date_trunc('week', d) as date)"

register("cal_week_bounds", WD + f"select d, {WSD} week_start, {WSD} + 6 week_end from days")(
    on_days(("week_start", cal.week_start), ("week_end", cal.week_end)))

register("cal_prev_week_bounds", WD + f"""
select d, {WSD} - 7 prev_week_start, {WSD} - 1 prev_week_end from days""")(
    on_days(("prev_week_start", cal.prev_week_start), ("prev_week_end", cal.prev_week_end)))

register("cal_month_bounds", WD + """
select d, cast(date_trunc('month', d) as date) month_start, last_day(d) month_end from days""")(
    on_days(("month_start", cal.month_start), ("month_end", cal.month_end)))

register("cal_month_end_exclusive", WD + """
select d, cast(date_trunc('month', d) + interval 1 month as date) month_end_exclusive
from days""")(on_days(("month_end_exclusive", cal.month_end_exclusive)))

register("cal_month_labels", WD + """
select d, lower(strftime(d, '%B')) month_name, strftime(d, '%Y-%m') year_month,
       upper(strftime(d, '%b')) || cast(year(d) as varchar) month_tag from days""")(
    on_days(("month_name", cal.month_name), ("year_month", cal.year_month),
            ("month_tag", cal.month_tag)))

register("cal_shift_days", WD + """
select d, d + 1 next_day, d - 7 week_before, d + 7 week_after from days""")(
    on_days(("next_day", lambda d: cal.shift_days(d, 1)),
            ("week_before", lambda d: cal.shift_days(d, -7)),
            ("week_after", lambda d: cal.shift_days(d, 7))))


@register("cal_run_days", """
with b as (select cast(min(o_orderdate) as date) s, cast(max(o_orderdate) as date) e
           from orders),
     spine as (select cast(unnest(generate_series(s, e, interval 1 day)) as date) run_date
               from b)
select run_date, day(run_date) in (1, 2, 5) by_month_day,
       isodow(run_date) in (1, 5, 7) by_weekday
from spine where day(run_date) in (1, 2, 5) or isodow(run_date) in (1, 5, 7)""")
def cal_run_days(spark, sf):
    """Run days (day of month 1, 2, 5; Monday, Friday, Sunday) over the
    date spine of the orders table — the branch rule as a filter."""
    b = T.read_table(spark, sf, "orders").agg(F.min("o_orderdate").alias("start"),
                                              F.max("o_orderdate").alias("end"))
    d = F.col("run_date")
    return (cal.date_spine(b, out_col="run_date")
            .select("run_date",
                    cal.is_run_day(d, days_of_month=(1, 2, 5)).alias("by_month_day"),
                    cal.is_run_day(d, weekdays=(0, 4, 6)).alias("by_weekday"))
            .filter(F.col("by_month_day") | F.col("by_weekday")))


def _backfill_sql(period_expr: str) -> str:
    return with_(ATTEMPTS) + f"""
select {period_expr} period_start, lti_user_id, attempt_type, count(*) attempt_count,
       count(case when is_correct then null else 1 end) attempt_failed_count
from attempts group by 1, 2, 3"""


register("backfill_daily", _backfill_sql("cast(created_at as date)"))(
    lambda spark, sf: A.backfill_user_type(T.attempts(spark, sf), "day"))
register("backfill_weekly", _backfill_sql("cast(date_trunc('week', created_at) as date)"))(
    lambda spark, sf: A.backfill_user_type(T.attempts(spark, sf), "week"))
register("backfill_monthly", _backfill_sql("cast(date_trunc('month', created_at) as date)"))(
    lambda spark, sf: A.backfill_user_type(T.attempts(spark, sf), "month"))
