"""Aggregates A1–A27 and the new-user join J2.

Each function takes a domain DataFrame (see ``sources.tables``) and the run
date ``ds`` where the reference has one; it filters the period (pushed to the
scan), groups, and stamps the period columns.  All aggregates are declarative
(``HashAggregate`` with map-side partial aggregation), so one hot key is
reduced to one partial row per input task before the shuffle; distinct counts
are rewritten by Catalyst into a two-level aggregation keyed by the distinct
value, which also spreads a hot group over many tasks.

Ratios use the exact half-up formula of ``functions.ratios``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import correctness as ok
from ..functions.ratios import half_up_avg, half_up_ratio, plain_ratio
from . import filters as flt

OK = "is_correct"


def _ts(d) -> F.Column:
    """A run-date stamp as TIMESTAMP (the reference's ``'ds'::timestamp``)."""
    return cal.as_date(d).cast("timestamp_ntz")


# --------------------------------------------------------------------------
# user × type counts per period
# --------------------------------------------------------------------------

def daily_user_type(att: DataFrame, ds) -> DataFrame:
    """A1 — per user × type for one day; NULL ``is_correct`` counts as failed."""
    return (flt.filter_day(att, ds)
            .groupBy("lti_user_id", "attempt_type")
            .agg(F.count(F.lit(1)).alias("attempt_count"),
                 ok.failed_null_counts(OK).alias("attempt_failed_count"))
            .withColumn("date", _ts(ds)))


def weekly_user_type(att: DataFrame, ds) -> DataFrame:
    """A2 — A1 over the calendar week holding ds, stamped with its Monday."""
    return (flt.filter_calendar_week(att, ds)
            .groupBy("lti_user_id", "attempt_type")
            .agg(F.count(F.lit(1)).alias("attempt_count"),
                 ok.failed_null_counts(OK).alias("attempt_failed_count"))
            .withColumn("date", cal.week_start(ds).cast("timestamp_ntz")))


def weekly_user_type_correct(att: DataFrame, ds) -> DataFrame:
    """A2b — week × user × type with the correct count."""
    return (flt.filter_calendar_week(att, ds)
            .groupBy("lti_user_id", "attempt_type")
            .agg(F.count(F.lit(1)).alias("cnt_attempt"),
                 ok.correct_count(OK).alias("cnt_correct"))
            .withColumn("date", cal.week_start(ds).cast("timestamp_ntz")))


def monthly_user_type_snapshot(att: DataFrame, ds) -> DataFrame:
    """A3 — month-to-date as loaded by day ds: rows in [month start, ds + 1)."""
    return (flt.in_range(att, "created_at", cal.month_start(ds), cal.shift_days(ds, 1))
            .groupBy("lti_user_id", "attempt_type")
            .agg(F.count(F.lit(1)).alias("attempt_count"),
                 ok.failed_null_counts(OK).alias("attempt_failed_count"))
            .withColumn("month_start", cal.month_start(ds).cast("timestamp_ntz"))
            .withColumn("snapshot_date", _ts(ds)))


def weekly_by_type(att: DataFrame, ds) -> DataFrame:
    """A22 — current week by type only."""
    return (flt.filter_calendar_week(att, ds)
            .groupBy("attempt_type")
            .agg(F.count(F.lit(1)).alias("attempt_count"),
                 ok.failed_null_counts(OK).alias("attempt_failed_count"))
            .withColumn("week_start", cal.week_start(ds).cast("timestamp_ntz")))


def failed_three_valued(stamped: DataFrame, ds) -> DataFrame:
    """A27 — rows stamped ``load_date = ds``; failed = ``NOT ok`` (NULL is not failed)."""
    return (flt.filter_stamp(stamped, load_date=ds)
            .groupBy("lti_user_id", "attempt_type")
            .agg(F.count(F.lit(1)).alias("attempt_count"),
                 ok.failed_three_valued(OK).alias("attempt_failed_count"))
            .withColumn("date", _ts(ds)))


# --------------------------------------------------------------------------
# rolling-week and FILTER-clause counts
# --------------------------------------------------------------------------

def rolling_week_true_false(att: DataFrame, ds) -> DataFrame:
    """A4 — seven days from ds: non-null count, true sum, false sum (NULL adds to false)."""
    return (flt.filter_rolling_week(att, ds)
            .groupBy("lti_user_id", "attempt_type")
            .agg(F.count(OK).alias("attempt_count"),
                 F.sum(F.when(F.col(OK), 1).otherwise(0)).cast("long").alias("attempt_count_true"),
                 F.sum(F.when(F.col(OK), 0).otherwise(1)).cast("long").alias("attempt_count_false"))
            .withColumn("date_start", cal.as_date(ds)))


def filter_clause(att: DataFrame, ds) -> DataFrame:
    """A5 — ``COUNT(attempt_type) FILTER (WHERE is_correct)`` per user × type, seven days."""
    return (flt.filter_rolling_week(att, ds)
            .groupBy("lti_user_id", "attempt_type")
            .agg(F.count(F.lit(1)).alias("cnt_attempt"),
                 F.count(F.when(F.col(OK), F.col("attempt_type"))).alias("cnt_correct"))
            .withColumn("date", _ts(ds)))


def ordinals_full_refresh(att: DataFrame) -> DataFrame:
    """A6 — correct, failed and total per the first two columns (``GROUP BY 1, 2``), all time."""
    first_two = att.select("lti_user_id", "attempt_type", "is_correct")
    return (first_two.groupBy(*first_two.columns[:2])
            .agg(ok.correct_count(OK).alias("cnt_correct"),
                 ok.failed_null_counts(OK).alias("attempt_fails_count"),
                 F.count(F.lit(1)).alias("cnt_attempts")))


# --------------------------------------------------------------------------
# weekly per-user and global rows
# --------------------------------------------------------------------------

def weekly_user_accuracy(att: DataFrame, ds) -> DataFrame:
    """A7 — per user over the seven days from ds (``week_start`` = ds):
    total, correct, accuracy % = round(avg(ok ? 1 : 0) * 100, 2)."""
    return (flt.filter_rolling_week(att, ds)
            .groupBy("lti_user_id")
            .agg(F.count(F.lit(1)).alias("total_attempts"),
                 ok.correct_sum(OK).alias("correct_attempts"))
            .select(cal.as_date(ds).alias("week_start"), "lti_user_id", "total_attempts",
                    "correct_attempts",
                    half_up_ratio("correct_attempts", "total_attempts", scale=2, times=100)
                    .alias("accuracy")))


def weekly_global(att: DataFrame, ds) -> DataFrame:
    """A8 — one row for the week ds .. ds + 6 (also when empty): totals,
    unrounded success %, distinct users, attempts per user, first and last time.
    The reference runs it on Mondays, where this is the calendar week."""
    return (flt.filter_rolling_week(att, ds)
            .agg(F.count(F.lit(1)).alias("total_attempts"),
                 ok.correct_sum(OK).alias("correct_attempts"),
                 F.countDistinct("lti_user_id").alias("unique_users"),
                 F.min("created_at").alias("min_created_at"),
                 F.max("created_at").alias("max_created_at"))
            .select(cal.as_date(ds).alias("week_start"), cal.shift_days(ds, 6).alias("week_end"),
                    "total_attempts", "correct_attempts",
                    (plain_ratio("correct_attempts", "total_attempts") * F.lit(100.0))
                    .alias("success_rate"),
                    "unique_users",
                    plain_ratio("total_attempts", "unique_users").alias("attempts_per_user_avg"),
                    "min_created_at", "max_created_at"))


def _score_stats(prefix: str = "") -> list:
    return [F.sum("score").alias("_score_sum"), F.count("score").alias("_score_n"),
            F.max("score").alias(f"max_{prefix}score"), F.min("score").alias(f"min_{prefix}score")]


def _avg_score(name: str = "avg_score") -> F.Column:
    return half_up_avg("_score_sum", "_score_n", scale=2, total_scale=2).alias(name)


def weekly_lesson_stddev(att: DataFrame, ds) -> DataFrame:
    """A13 — week × user × type × lesson with rounded sample standard deviation."""
    ws = cal.week_start(ds)
    g = (flt.filter_calendar_week(att, ds)
         .groupBy("lti_user_id", "attempt_type", "lesson_id", "lesson_name")
         .agg(F.count(F.lit(1)).alias("attempt_count"),
              ok.correct_count(OK).alias("correct_count"),
              ok.failed_three_valued(OK).alias("incorrect_count"),
              *_score_stats(),
              F.stddev_samp("score").alias("_sd"),
              F.min("created_at").alias("first_attempt"),
              F.max("created_at").alias("last_attempt")))
    return g.select("lti_user_id", "attempt_type", "lesson_id", "lesson_name", "attempt_count",
                    "correct_count", "incorrect_count", _avg_score(), "max_score", "min_score",
                    F.round(F.col("_sd"), 2).alias("stddev_score"),
                    "first_attempt", "last_attempt",
                    ws.cast("timestamp_ntz").alias("week_start"),
                    F.date_add(ws, 6).cast("timestamp_ntz").alias("week_end"))


def period_profile(att: DataFrame, ds, kind: str = "week") -> DataFrame:
    """A25 — probe of a period: rows, distinct users, first and last record."""
    return (flt.in_period(att, kind, ds)
            .agg(F.count(F.lit(1)).alias("total_records"),
                 F.countDistinct("lti_user_id").alias("unique_users"),
                 F.min("created_at").alias("first_record"),
                 F.max("created_at").alias("last_record")))


# --------------------------------------------------------------------------
# monthly tables
# --------------------------------------------------------------------------

def _month_cols(ds):
    return [cal.year_month(ds).alias("year_month"), cal.as_date(ds).alias("load_date")]


def monthly_user_attempts(att: DataFrame, ds) -> DataFrame:
    """A9 — month × user × type; incorrect = ``NOT ok`` (NULL in neither)."""
    g = (flt.filter_calendar_month(att, ds)
         .groupBy("lti_user_id", "attempt_type")
         .agg(F.count(F.lit(1)).alias("total_attempts"),
              ok.correct_count(OK).alias("correct_attempts"),
              ok.failed_three_valued(OK).alias("incorrect_attempts"),
              *_score_stats(),
              F.min("created_at").alias("first_attempt_date"),
              F.max("created_at").alias("last_attempt_date")))
    return g.select("lti_user_id", "attempt_type", "total_attempts", "correct_attempts",
                    "incorrect_attempts", _avg_score(), "max_score", "min_score",
                    "first_attempt_date", "last_attempt_date", *_month_cols(ds))


def monthly_lesson_stats(att: DataFrame, ds) -> DataFrame:
    """A10 — month × lesson (non-null lessons): name, totals, distinct users, success %."""
    g = (flt.filter_not_null(flt.filter_calendar_month(att, ds), "lesson_id")
         .groupBy("lesson_id")
         .agg(F.max("lesson_name").alias("lesson_name"),
              F.count(F.lit(1)).alias("total_attempts"),
              F.countDistinct("lti_user_id").alias("unique_users"),
              ok.correct_count(OK).alias("_correct"),
              *_score_stats()))
    return g.select("lesson_id", "lesson_name", "total_attempts", "unique_users",
                    half_up_ratio("_correct", "total_attempts", scale=2, times=100, precision=5)
                    .alias("success_rate"),
                    _avg_score(), "max_score", "min_score", *_month_cols(ds))


def monthly_daily_activity(att: DataFrame, ds) -> DataFrame:
    """A11 — month by day × type: counts and distinct users."""
    return (flt.filter_calendar_month(att, ds)
            .groupBy(F.col("created_at").cast("date").alias("activity_date"), "attempt_type")
            .agg(F.count(F.lit(1)).alias("attempt_count"),
                 F.countDistinct("lti_user_id").alias("unique_users"),
                 ok.correct_count(OK).alias("correct_count"),
                 ok.failed_three_valued(OK).alias("incorrect_count"))
            .select("activity_date", "attempt_type", "attempt_count", "unique_users",
                    "correct_count", "incorrect_count", *_month_cols(ds)))


def monthly_summary(att: DataFrame, ds) -> DataFrame:
    """A12 — one row per month with rows: several distinct counts in one pass
    (Catalyst expands the rows once per distinct column)."""
    g = (flt.filter_calendar_month(att, ds)
         .groupBy(cal.year_month(F.col("created_at")).alias("year_month"))
         .agg(F.countDistinct("lti_user_id").alias("total_users"),
              F.count(F.lit(1)).alias("total_attempts"),
              ok.correct_count(OK).alias("total_correct"),
              ok.failed_three_valued(OK).alias("total_incorrect"),
              F.sum("score").alias("_score_sum"), F.count("score").alias("_score_n"),
              F.countDistinct(F.col("created_at").cast("date")).alias("active_days"),
              F.min("created_at").alias("first_date"),
              F.max("created_at").alias("last_date")))
    return g.select("year_month", "total_users", "total_attempts", "total_correct",
                    "total_incorrect",
                    half_up_ratio("total_correct", "total_attempts", scale=2, times=100,
                                  precision=5).alias("overall_success_rate"),
                    _avg_score(), "active_days", "first_date", "last_date",
                    cal.as_date(ds).alias("load_date"))


# --------------------------------------------------------------------------
# daily and previous-week spec tables
# --------------------------------------------------------------------------

def daily_by_type(att: DataFrame, ds) -> DataFrame:
    """A20a."""
    return (flt.filter_day(att, ds).groupBy("attempt_type")
            .agg(F.count(F.lit(1)).alias("attempts"), ok.correct_sum(OK).alias("correct"))
            .withColumn("ds", cal.as_date(ds)))


def daily_by_user(att: DataFrame, ds) -> DataFrame:
    """A20b."""
    return (flt.filter_day(att, ds).groupBy("lti_user_id")
            .agg(F.count(F.lit(1)).alias("attempts"))
            .withColumn("ds", cal.as_date(ds)))


def _rate4(k: str, n: str):
    """``ROUND(AVG(CASE WHEN ok THEN 1.0 ELSE 0.0 END), 4)`` from its exact parts."""
    return half_up_ratio(k, n, scale=4)


def daily_summary(att: DataFrame, ds) -> DataFrame:
    """A20c — global row for a day; sums are NULL (not 0) when the day is empty.

    The period is stamped as [ds, ds + 1): ``period_end`` is exclusive.
    """
    g = (flt.filter_day(att, ds)
         .agg(F.count(F.lit(1)).alias("total_attempts"),
              ok.correct_sum(OK).alias("correct_attempts"),
              ok.failed_sum_zero(OK).alias("incorrect_attempts"),
              F.countDistinct("lti_user_id").alias("unique_users"),
              ok.correct_count(OK).alias("_k")))
    return g.select(cal.as_date(ds).alias("period_start"),
                    cal.shift_days(ds, 1).alias("period_end"),
                    "total_attempts", "correct_attempts", "incorrect_attempts", "unique_users",
                    _rate4("_k", "total_attempts").alias("correct_rate"))


def _prev_week_cols(ds):
    return [cal.prev_week_start(ds).alias("period_start"),
            cal.prev_week_end(ds).alias("period_end")]


def prev_week_by_type(att: DataFrame, ds) -> DataFrame:
    """A21a."""
    g = (flt.filter_prev_week(att, ds).groupBy("attempt_type")
         .agg(F.count(F.lit(1)).alias("total_attempts"),
              ok.correct_count(OK).alias("correct_attempts"),
              ok.failed_three_valued(OK).alias("incorrect_attempts"),
              F.countDistinct("lti_user_id").alias("unique_users"),
              F.min("created_at").alias("min_created_at"),
              F.max("created_at").alias("max_created_at")))
    return g.select("attempt_type", "total_attempts", "correct_attempts", "incorrect_attempts",
                    "unique_users", _rate4("correct_attempts", "total_attempts")
                    .alias("avg_correct_rate"),
                    "min_created_at", "max_created_at", *_prev_week_cols(ds))


def prev_week_by_user(att: DataFrame, ds) -> DataFrame:
    """A21b."""
    g = (flt.filter_prev_week(att, ds).groupBy("lti_user_id", "attempt_type")
         .agg(F.count(F.lit(1)).alias("total_attempts"),
              ok.correct_count(OK).alias("correct_attempts"),
              ok.failed_three_valued(OK).alias("incorrect_attempts")))
    return g.select("lti_user_id", "attempt_type", "total_attempts", "correct_attempts",
                    "incorrect_attempts", _rate4("correct_attempts", "total_attempts")
                    .alias("avg_correct_rate"), *_prev_week_cols(ds))


def prev_week_summary(att: DataFrame, ds) -> DataFrame:
    """A21c — one global row, including the number of distinct attempt types."""
    g = (flt.filter_prev_week(att, ds)
         .agg(F.count(F.lit(1)).alias("total_attempts"),
              ok.correct_count(OK).alias("correct_attempts"),
              ok.failed_three_valued(OK).alias("incorrect_attempts"),
              F.countDistinct("lti_user_id").alias("unique_users"),
              F.countDistinct("attempt_type").alias("unique_attempt_types"),
              F.min("created_at").alias("min_created_at"),
              F.max("created_at").alias("max_created_at")))
    return g.select("total_attempts", "correct_attempts", "incorrect_attempts", "unique_users",
                    "unique_attempt_types",
                    _rate4("correct_attempts", "total_attempts").alias("avg_correct_rate"),
                    "min_created_at", "max_created_at", *_prev_week_cols(ds))


# --------------------------------------------------------------------------
# all-time tables
# --------------------------------------------------------------------------

def count_by_attribute(df: DataFrame, col: str) -> DataFrame:
    """A19a — row count per value; NULL is a group of its own."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("total_rows"))


def nonnull_by_type(att: DataFrame) -> DataFrame:
    """A19b — ``COUNT(lti_user_id)`` per type: non-null, not distinct."""
    return att.groupBy("attempt_type").agg(F.count("lti_user_id").alias("cnt_user"))


def alltime_by_user(att: DataFrame) -> DataFrame:
    """A23."""
    return att.groupBy("lti_user_id").agg(F.count(F.lit(1)).alias("total_attempts"),
                                          F.count_if(OK).alias("correct_answers"))


def alltime_by_day(att: DataFrame) -> DataFrame:
    """A23."""
    return (att.groupBy(F.col("created_at").cast("date").alias("day"))
            .agg(F.count(F.lit(1)).alias("total_attempts")))


def alltime_totals(att: DataFrame) -> DataFrame:
    """A24 — one row, also for an empty table."""
    return att.agg(F.count(F.lit(1)).alias("total_rows"),
                   F.countDistinct("lti_user_id").alias("unique_users"),
                   F.count_if(OK).alias("correct_answers"))


def first_activity(att: DataFrame, start, end) -> DataFrame:
    """A26 — first activity per user in [start, end)."""
    return (flt.in_range(att, "created_at", start, end).groupBy("lti_user_id")
            .agg(F.min("created_at").alias("first_activity")))


def last_seen(att: DataFrame) -> DataFrame:
    """Latest attempt per user, with its day (a user dimension whose partition moves)."""
    return (att.groupBy("lti_user_id")
            .agg(F.max("created_at").alias("last_seen"), F.max_by("attempt_type", "created_at").alias("last_type"))
            .withColumn("last_day", F.col("last_seen").cast("date")))


# --------------------------------------------------------------------------
# J2 — new users in a period
# --------------------------------------------------------------------------

def new_users(att: DataFrame, start, end) -> DataFrame:
    """Period [start, end) totals with the number of users never seen before ``start``.

    The reference left-joins the period rows to the DISTINCT users seen
    before ``start``.  The same answer comes from one aggregation per user
    over ``created_at < end``: a user is new when their first activity is
    >= start.  That is one scan and one shuffle (with map-side partial
    aggregation, so a very active user costs one row per task), instead of
    two shuffles for distinct + join.  Zero rows when the period is empty,
    as with the reference's GROUP BY.
    """
    s_ts = cal.as_date(start).cast("timestamp_ntz")
    in_p = F.col("created_at") >= s_ts
    per_user = (flt.filter_before(att, end)
                .groupBy("lti_user_id")
                .agg(F.min("created_at").alias("_first"),
                     F.count(F.when(in_p, 1)).alias("_n"),
                     F.count(F.when(in_p & (ok.correct_raw_int(OK) == 1), 1)).alias("_c"))
                .filter(F.col("_n") > 0))
    tag = cal.month_tag(start)
    return (per_user.groupBy(tag.alias("date_tag"))
            .agg(F.sum("_n").cast("long").alias("attempts_total"),
                 F.sum("_c").cast("long").alias("correct_attempts"),
                 F.count("lti_user_id").alias("unique_users"),               # rows without a user are no user
                 F.count(F.when(F.col("_first") >= s_ts, F.col("lti_user_id"))).alias("new_users"))
            .select(cal.as_date(start).alias("period_start"),
                    F.date_sub(cal.as_date(end), 1).alias("period_end"),
                    "attempts_total", "correct_attempts", "unique_users", "new_users",
                    "date_tag"))


def new_users_from_dim(att: DataFrame, users: DataFrame, start, end) -> DataFrame:
    """J2 against the users dimension (A26 maintained by insert-ignore).

    Same result as ``new_users`` without rescanning history: the period's
    rows are first reduced to one row per user (partial aggregation, so a
    hot user costs one row per task), then left-joined to the users whose
    first activity is before ``start``.  The join has one row per active
    user on each side; AQE picks broadcast or sort-merge from the measured
    sizes.
    """
    s_ts = cal.as_date(start).cast("timestamp_ntz")
    per_user = (flt.in_range(att, "created_at", start, end).groupBy("lti_user_id")
                .agg(F.count(F.lit(1)).alias("_n"),
                     F.count(F.when(ok.correct_raw_int(OK) == 1, 1)).alias("_c")))
    earlier = (users.filter(F.col("first_activity") < s_ts).select("lti_user_id")
               .withColumn("_seen", F.lit(True)))
    j = per_user.join(earlier, "lti_user_id", "left")
    return (j.groupBy(cal.month_tag(start).alias("date_tag"))
            .agg(F.sum("_n").cast("long").alias("attempts_total"),
                 F.sum("_c").cast("long").alias("correct_attempts"),
                 F.count("lti_user_id").alias("unique_users"),
                 F.count(F.when(F.col("_seen").isNull(), F.col("lti_user_id"))).alias("new_users"))
            .select(cal.as_date(start).alias("period_start"),
                    F.date_sub(cal.as_date(end), 1).alias("period_end"),
                    "attempts_total", "correct_attempts", "unique_users", "new_users",
                    "date_tag"))


# --------------------------------------------------------------------------
# purchases, café, sales, series
# --------------------------------------------------------------------------

def daily_revenue_by_plan(pur: DataFrame, ds) -> DataFrame:
    """A14 — one row per day (also when empty), revenue pivoted by plan."""
    price = F.col("price")
    plan = F.col("subscription_plan")
    d = flt.filter_day(pur, ds, col="_purchase_ts").filter(F.col("status") == "success")
    dec = "decimal(18,2)"
    return d.agg(
        F.sum(price).cast(dec).alias("total_revenue"),
        F.sum(F.when(plan == "month", price).otherwise(0)).cast(dec).alias("revenue_monthly_plan"),
        F.sum(F.when(plan == "year", price).otherwise(0)).cast(dec).alias("revenue_yearly_plan"),
        F.sum(F.when(plan == "trial", price).otherwise(0)).cast(dec).alias("revenue_trial"),
        F.count(F.lit(1)).alias("total_purchases"),
    ).select(cal.as_date(ds).alias("purchase_date"), "total_revenue", "revenue_monthly_plan",
             "revenue_yearly_plan", "revenue_trial", "total_purchases")


def payment_method(pur: DataFrame, ds) -> DataFrame:
    """A15."""
    d = flt.filter_day(pur, ds, col="_purchase_ts").filter(F.col("status") == "success")
    return (d.groupBy("purchase_date", "payment_method")
            .agg(F.count(F.lit(1)).alias("total_purchases"),
                 F.sum("price").cast("decimal(15,2)").alias("total_amount")))


def revenue_by_branch(cafe: DataFrame) -> DataFrame:
    """A16a — café orders already cut to the day(s) wanted."""
    return (cafe.groupBy("report_date", "branch")
            .agg(F.count(F.lit(1)).alias("orders_count"),
                 F.sum("amount").cast("decimal(14,2)").alias("total_revenue")))


def top_dishes(cafe: DataFrame, n: int | None = None) -> DataFrame:
    """A16b — quantity and revenue by dish, ranked by revenue.

    With ``n`` the ranking is cut to the top ``n`` per run (TakeOrderedAndProject:
    each task keeps ``n`` rows, so nothing unbounded reaches one task).
    """
    g = (cafe.groupBy("report_date", "dish")
         .agg(F.sum("qty").cast("long").alias("total_qty"),
              F.sum("amount").cast("decimal(14,2)").alias("total_revenue")))
    g = g.orderBy(F.desc("total_revenue"), F.asc("dish"))
    return g.limit(n) if n else g


def stats_by_category(cafe: DataFrame) -> DataFrame:
    """A16c — quantity, revenue and average price (NUMERIC(10,2)) by category."""
    g = (cafe.groupBy("report_date", "category")
         .agg(F.sum("qty").cast("long").alias("total_qty"),
              F.sum("amount").cast("decimal(14,2)").alias("total_revenue"),
              F.sum("price").alias("_p"), F.count("price").alias("_n")))
    return g.select("report_date", "category", "total_qty", "total_revenue",
                    half_up_avg("_p", "_n", scale=2, total_scale=2).alias("avg_price"))


def avg_price_by_category(sales_df: DataFrame, ds) -> DataFrame:
    """A17a — open-ended ``sale_date >= ds``."""
    g = (flt.filter_since(sales_df, ds, "sale_date").groupBy("category_name")
         .agg(F.sum("price").alias("_p"), F.count("price").alias("_n")))
    return g.select("category_name", half_up_avg("_p", "_n").alias("avg_price"),
                    cal.as_date(ds).alias("load_date"))


def sales_by_manager(sales_df: DataFrame, ds) -> DataFrame:
    """A17b."""
    return (flt.filter_since(sales_df, ds, "sale_date").groupBy("manager_name")
            .agg(F.count(F.lit(1)).alias("total_sales"))
            .withColumn("load_date", cal.as_date(ds)))


def _whole_sum(col: str) -> F.Column:
    return F.sum(F.col(col).cast("decimal(28,0)")).cast("decimal(38,0)")


def sum_by_category(series_df: DataFrame) -> DataFrame:
    """A18a — summed in 38 digits: a BIGINT total of large ids overflows."""
    return series_df.groupBy("category").agg(_whole_sum("amount").alias("sum_amount"))


def integer_average(series_df: DataFrame) -> DataFrame:
    """A18b — ``sum(amount) / count(1)`` on integers truncates toward zero."""
    g = series_df.groupBy("category").agg(_whole_sum("amount").alias("_s"),
                                          F.count(F.lit(1)).alias("_n"))
    return g.select("category", F.expr("_s div _n").alias("average_amount"))


def rounded_average(series_df: DataFrame, ds) -> DataFrame:
    """A18c — ``avg(amount)`` assigned to an INT column: rounded half away from zero."""
    g = series_df.groupBy("category").agg(_whole_sum("amount").alias("_s"),
                                          F.count(F.lit(1)).alias("_n"))
    return g.select("category",
                    half_up_ratio("_s", "_n", scale=0, precision=18).cast("long").alias("amount"),
                    cal.as_date(ds).alias("load_date"))


def sum_by_product(cafe: DataFrame, ds) -> DataFrame:
    """A18d — quantity summed by product (dish)."""
    return (cafe.groupBy(F.col("dish").alias("product"))
            .agg(F.sum("qty").cast("long").alias("amount"))
            .withColumn("load_date", cal.as_date(ds)))


def category_stock(products_df: DataFrame, categories_df: DataFrame) -> DataFrame:
    """J1 — products joined to categories, stock summed by category name.

    No hint: the category side is an aggregate, whose size Catalyst cannot
    bound before it runs; AQE measures it after its shuffle stage and turns
    the join into a broadcast join when it is small (it is: one row per
    brand), else keeps the sort-merge join.  A pre-counting check would
    compute the distinct twice.
    """
    return (products_df.join(categories_df, "category_id")
            .groupBy("category_name")
            .agg(F.sum("units_in_stock").cast("long").alias("units_in_stock"),
                 F.count(F.lit(1)).alias("products")))


# --------------------------------------------------------------------------
# D9 — back-fills: every period of a range in one job
# --------------------------------------------------------------------------

def backfill_user_type(att: DataFrame, kind: str, start=None, end=None) -> DataFrame:
    """A1 for every ``kind`` period (day / week / month) in [start, end), one job.

    The reference re-runs the daily job once per date (catch-up); grouping by
    the derived period key does all periods in one scan and one shuffle.
    """
    if start is not None and end is not None:
        att = flt.in_range(att, "created_at", start, end)
    return (att.groupBy(cal.period_key(kind, F.col("created_at")).alias("period_start"),
                        "lti_user_id", "attempt_type")
            .agg(F.count(F.lit(1)).alias("attempt_count"),
                 ok.failed_null_counts(OK).alias("attempt_failed_count")))


def daily_by_type_range(att: DataFrame, start, end) -> DataFrame:
    """A20a for every day of [start, end) in one job, keyed by ``ds``."""
    return (flt.in_range(att, "created_at", start, end)
            .groupBy(F.col("created_at").cast("date").alias("ds"), "attempt_type")
            .agg(F.count(F.lit(1)).alias("attempts"), ok.correct_sum(OK).alias("correct")))
