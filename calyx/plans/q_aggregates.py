"""Registered aggregate queries (A1–A27, J1, J2) with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.ratios import duck_half_up as R
from ..functions.ratios import duck_half_up_avg as AVG
from ..operators import aggregates as A
from ..operators import writes as W
from ..session import scratch_path
from ..operators.normalize import stamp_periods
from ..sources import tables as T
from .params import (DS, DS_CAFE, DS_MONTH, DS_NEXT_WEEK, DS_ORDERS, DS_SALES, month_start,
                     next_month, plus, week_start)
from .registry import ATTEMPTS, CAFE, PURCHASES, SERIES, register, with_

WA = with_(ATTEMPTS)
WS, WE = week_start(DS), plus(week_start(DS), 7)
PWS, PWE = plus(week_start(DS_NEXT_WEEK), -7), week_start(DS_NEXT_WEEK)
MS, ME = month_start(DS_MONTH), next_month(DS_MONTH)


def rng(s, e, col="created_at"):
    return f"{col} >= timestamp '{s}' and {col} < timestamp '{e}'"


def att(spark, sf):
    return T.attempts(spark, sf)


FAILED_NULL = "count(case when is_correct then null else 1 end)"
FAILED_NOT = "count(case when not is_correct then 1 end)"
CORRECT_CNT = "count(case when is_correct then 1 end)"
CORRECT_SUM = "cast(sum(case when is_correct then 1 else 0 end) as bigint)"

# ----------------------------------------------------------------- user × type

register("agg_daily_user_type", WA + f"""
select lti_user_id, attempt_type, count(*) attempt_count, {FAILED_NULL} attempt_failed_count,
       timestamp '{DS}' "date"
from attempts where {rng(DS, plus(DS, 1))} group by 1, 2""")(
    lambda spark, sf: A.daily_user_type(att(spark, sf), DS))

WEEKLY_USER_TYPE_SQL = WA + f"""
select lti_user_id, attempt_type, count(*) attempt_count, {FAILED_NULL} attempt_failed_count,
       timestamp '{WS}' "date"
from attempts where {rng(WS, WE)} group by 1, 2"""
register("agg_weekly_user_type", WEEKLY_USER_TYPE_SQL)(
    lambda spark, sf: A.weekly_user_type(att(spark, sf), DS))

register("agg_weekly_user_type_correct", WA + f"""
select lti_user_id, attempt_type, count(*) cnt_attempt, {CORRECT_CNT} cnt_correct,
       timestamp '{WS}' "date"
from attempts where {rng(WS, WE)} group by 1, 2""")(
    lambda spark, sf: A.weekly_user_type_correct(att(spark, sf), DS))

register("agg_monthly_user_type_snapshot", WA + f"""
select lti_user_id, attempt_type, count(*) attempt_count, {FAILED_NULL} attempt_failed_count,
       timestamp '{MS}' month_start, timestamp '{DS_MONTH}' snapshot_date
from attempts where {rng(MS, plus(DS_MONTH, 1))} group by 1, 2""")(
    lambda spark, sf: A.monthly_user_type_snapshot(att(spark, sf), DS_MONTH))

register("agg_weekly_by_type", WA + f"""
select attempt_type, count(*) attempt_count, {FAILED_NULL} attempt_failed_count,
       timestamp '{WS}' week_start
from attempts where {rng(WS, WE)} group by 1""")(
    lambda spark, sf: A.weekly_by_type(att(spark, sf), DS))

register("agg_failed_three_valued", WA + f"""
select lti_user_id, attempt_type, count(*) attempt_count, {FAILED_NOT} attempt_failed_count,
       timestamp '{DS}' "date"
from attempts where cast(created_at as date) = date '{DS}' group by 1, 2""")(
    lambda spark, sf: A.failed_three_valued(stamp_periods(att(spark, sf)), DS))

# ---------------------------------------------------------- rolling / FILTER

register("agg_rolling_week_true_false", WA + f"""
select lti_user_id, attempt_type, count(is_correct) attempt_count,
       {CORRECT_SUM} attempt_count_true,
       cast(sum(case when is_correct then 0 else 1 end) as bigint) attempt_count_false,
       date '{DS}' date_start
from attempts where {rng(DS, plus(DS, 7))} group by 1, 2""")(
    lambda spark, sf: A.rolling_week_true_false(att(spark, sf), DS))

register("agg_filter_clause", WA + f"""
select lti_user_id, attempt_type, count(*) cnt_attempt,
       count(attempt_type) filter (where is_correct) cnt_correct, timestamp '{DS}' "date"
from attempts where {rng(DS, plus(DS, 7))} group by 1, 2""")(
    lambda spark, sf: A.filter_clause(att(spark, sf), DS))

register("agg_ordinals_full_refresh", WA + f"""
select lti_user_id, attempt_type, {CORRECT_CNT} cnt_correct, {FAILED_NULL} attempt_fails_count,
       count(*) cnt_attempts
from attempts group by 1, 2""")(
    lambda spark, sf: A.ordinals_full_refresh(att(spark, sf)))

# ------------------------------------------------------------- weekly rows

register("agg_weekly_user_accuracy", WA + f"""
select date '{DS}' week_start, lti_user_id, count(*) total_attempts,
       {CORRECT_SUM} correct_attempts,
       {R(CORRECT_CNT, 'count(*)', scale=2, times=100)} accuracy
from attempts where {rng(DS, plus(DS, 7))} group by lti_user_id""")(
    lambda spark, sf: A.weekly_user_accuracy(att(spark, sf), DS))

register("agg_weekly_global", WA + f"""
select date '{DS}' week_start, date '{plus(DS, 6)}' week_end, count(*) total_attempts,
       {CORRECT_SUM} correct_attempts,
       cast(sum(case when is_correct then 1 else 0 end) as double)
         / nullif(cast(count(*) as double), 0) * 100.0 success_rate,
       count(distinct lti_user_id) unique_users,
       cast(count(*) as double) / nullif(cast(count(distinct lti_user_id) as double), 0)
         attempts_per_user_avg,
       min(created_at) min_created_at, max(created_at) max_created_at
from attempts where {rng(DS, plus(DS, 7))}""")(
    lambda spark, sf: A.weekly_global(att(spark, sf), DS))

register("agg_weekly_lesson_stddev", WA + f"""
select lti_user_id, attempt_type, lesson_id, lesson_name, count(*) attempt_count,
       {CORRECT_CNT} correct_count, {FAILED_NOT} incorrect_count,
       {AVG('sum(score)', 'count(score)')} avg_score, max(score) max_score, min(score) min_score,
       round(stddev_samp(score), 2) stddev_score,
       min(created_at) first_attempt, max(created_at) last_attempt,
       timestamp '{WS}' week_start, timestamp '{plus(WS, 6)}' week_end
from attempts where {rng(WS, WE)} group by 1, 2, 3, 4""")(
    lambda spark, sf: A.weekly_lesson_stddev(att(spark, sf), DS))

register("agg_period_profile", WA + f"""
select count(*) total_records, count(distinct lti_user_id) unique_users,
       min(created_at) first_record, max(created_at) last_record
from attempts where {rng(WS, WE)}""")(
    lambda spark, sf: A.period_profile(att(spark, sf), DS, "week"))

# ------------------------------------------------------------------ monthly

YM = f"'{DS_MONTH[:7]}' year_month, date '{DS_MONTH}' load_date"

register("agg_monthly_user_attempts", WA + f"""
select lti_user_id, attempt_type, count(*) total_attempts, {CORRECT_CNT} correct_attempts,
       {FAILED_NOT} incorrect_attempts, {AVG('sum(score)', 'count(score)')} avg_score,
       max(score) max_score, min(score) min_score,
       min(created_at) first_attempt_date, max(created_at) last_attempt_date, {YM}
from attempts where {rng(MS, ME)} group by 1, 2""")(
    lambda spark, sf: A.monthly_user_attempts(att(spark, sf), DS_MONTH))

register("agg_monthly_lesson_stats", WA + f"""
select lesson_id, max(lesson_name) lesson_name, count(*) total_attempts,
       count(distinct lti_user_id) unique_users,
       {R(CORRECT_CNT, 'count(*)', scale=2, times=100, precision=5)} success_rate,
       {AVG('sum(score)', 'count(score)')} avg_score, max(score) max_score, min(score) min_score,
       {YM}
from attempts where {rng(MS, ME)} and lesson_id is not null group by lesson_id""")(
    lambda spark, sf: A.monthly_lesson_stats(att(spark, sf), DS_MONTH))

# F10 at work: the lesson of every seventh attempt is unknown
register("agg_monthly_lesson_stats_nulls", WA + f"""
select lesson_id, max(lesson_name) lesson_name, count(*) total_attempts,
       count(distinct lti_user_id) unique_users,
       {R(CORRECT_CNT, 'count(*)', scale=2, times=100, precision=5)} success_rate,
       {AVG('sum(score)', 'count(score)')} avg_score, max(score) max_score, min(score) min_score,
       {YM}
from attempts where {rng(MS, ME)} and event_id % 7 <> 0 group by lesson_id""")(
    lambda spark, sf: A.monthly_lesson_stats(att(spark, sf).withColumn(
        "lesson_id", F.when(F.col("event_id") % 7 != 0, F.col("lesson_id"))), DS_MONTH))

register("agg_monthly_daily_activity", WA + f"""
select cast(created_at as date) activity_date, attempt_type, count(*) attempt_count,
       count(distinct lti_user_id) unique_users, {CORRECT_CNT} correct_count,
       {FAILED_NOT} incorrect_count, {YM}
from attempts where {rng(MS, ME)} group by 1, 2""")(
    lambda spark, sf: A.monthly_daily_activity(att(spark, sf), DS_MONTH))

register("agg_monthly_summary", WA + f"""
select strftime(created_at, '%Y-%m') year_month, count(distinct lti_user_id) total_users,
       count(*) total_attempts, {CORRECT_CNT} total_correct, {FAILED_NOT} total_incorrect,
       {R(CORRECT_CNT, 'count(*)', scale=2, times=100, precision=5)} overall_success_rate,
       {AVG('sum(score)', 'count(score)')} avg_score,
       count(distinct cast(created_at as date)) active_days,
       min(created_at) first_date, max(created_at) last_date, date '{DS_MONTH}' load_date
from attempts where {rng(MS, ME)} group by 1""")(
    lambda spark, sf: A.monthly_summary(att(spark, sf), DS_MONTH))

# ---------------------------------------------------------- daily spec tables

register("agg_daily_by_type", WA + f"""
select attempt_type, count(*) attempts, {CORRECT_SUM} correct, date '{DS}' ds
from attempts where {rng(DS, plus(DS, 1))} group by 1""")(
    lambda spark, sf: A.daily_by_type(att(spark, sf), DS))

register("agg_daily_by_user", WA + f"""
select lti_user_id, count(*) attempts, date '{DS}' ds
from attempts where {rng(DS, plus(DS, 1))} group by 1""")(
    lambda spark, sf: A.daily_by_user(att(spark, sf), DS))

DAILY_SUMMARY_SQL = """
select date '{d}' period_start, date '{d}' + 1 period_end, count(*) total_attempts,
       {cs} correct_attempts,
       cast(sum(case when not is_correct then 1 else 0 end) as bigint) incorrect_attempts,
       count(distinct lti_user_id) unique_users, {rate} correct_rate
from attempts where {where}"""


def daily_summary_sql(d: str, extra: str = "") -> str:
    return DAILY_SUMMARY_SQL.format(d=d, cs=CORRECT_SUM, rate=R(CORRECT_CNT, "count(*)", scale=4),
                                    where=rng(d, plus(d, 1)) + extra)


register("agg_daily_summary", WA + daily_summary_sql(DS))(
    lambda spark, sf: A.daily_summary(att(spark, sf), DS))

PREV = f"date '{PWS}' period_start, date '{plus(PWE, -1)}' period_end"
RATE4 = R(CORRECT_CNT, "count(*)", scale=4)

register("agg_prev_week_by_type", WA + f"""
select attempt_type, count(*) total_attempts, {CORRECT_CNT} correct_attempts,
       {FAILED_NOT} incorrect_attempts, count(distinct lti_user_id) unique_users,
       {RATE4} avg_correct_rate, min(created_at) min_created_at, max(created_at) max_created_at,
       {PREV}
from attempts where {rng(PWS, PWE)} group by 1""")(
    lambda spark, sf: A.prev_week_by_type(att(spark, sf), DS_NEXT_WEEK))

register("agg_prev_week_by_user", WA + f"""
select lti_user_id, attempt_type, count(*) total_attempts, {CORRECT_CNT} correct_attempts,
       {FAILED_NOT} incorrect_attempts, {RATE4} avg_correct_rate, {PREV}
from attempts where {rng(PWS, PWE)} group by 1, 2""")(
    lambda spark, sf: A.prev_week_by_user(att(spark, sf), DS_NEXT_WEEK))

register("agg_prev_week_summary", WA + f"""
select count(*) total_attempts, {CORRECT_CNT} correct_attempts, {FAILED_NOT} incorrect_attempts,
       count(distinct lti_user_id) unique_users, count(distinct attempt_type) unique_attempt_types,
       {RATE4} avg_correct_rate, min(created_at) min_created_at, max(created_at) max_created_at,
       {PREV}
from attempts where {rng(PWS, PWE)}""")(
    lambda spark, sf: A.prev_week_summary(att(spark, sf), DS_NEXT_WEEK))

# ------------------------------------------------------------------ all time

register("agg_nonnull_by_type", WA + """
select attempt_type, count(lti_user_id) cnt_user from attempts group by 1""")(
    lambda spark, sf: A.nonnull_by_type(att(spark, sf)))

register("agg_alltime_by_user", WA + """
select lti_user_id, count(*) total_attempts, count(*) filter (where is_correct = true)
       correct_answers
from attempts group by 1""")(lambda spark, sf: A.alltime_by_user(att(spark, sf)))

register("agg_alltime_by_day", WA + """
select cast(created_at as date) "day", count(*) total_attempts from attempts group by 1""")(
    lambda spark, sf: A.alltime_by_day(att(spark, sf)))

register("agg_alltime_totals", WA + """
select count(*) total_rows, count(distinct lti_user_id) unique_users,
       count(*) filter (where is_correct = true) correct_answers from attempts""")(
    lambda spark, sf: A.alltime_totals(att(spark, sf)))

register("agg_first_activity", WA + f"""
select lti_user_id, min(created_at) first_activity from attempts
where {rng(WS, WE)} group by 1""")(
    lambda spark, sf: A.first_activity(att(spark, sf), str(WS), str(WE)))

# J2 — the reference's left join to the distinct earlier users, as the oracle
NEW_USERS_SQL = WA + f"""
select date '{WS}' period_start, date '{plus(WE, -1)}' period_end, count(*) attempts_total,
       count(case when d.is_correct then 1 end) correct_attempts,
       count(distinct d.lti_user_id) unique_users,
       count(distinct case when u.lti_user_id is null then d.lti_user_id end) new_users,
       upper(strftime(date '{WS}', '%b')) || cast(year(date '{WS}') as varchar) date_tag
from attempts d
left join (select distinct lti_user_id from attempts where created_at < timestamp '{WS}') u
  on d.lti_user_id = u.lti_user_id
where d.created_at >= timestamp '{WS}' and d.created_at < timestamp '{WE}'
group by date_tag"""
register("agg_new_users", NEW_USERS_SQL)(lambda spark, sf: A.new_users(att(spark, sf), str(WS), str(WE)))


def _some_without_user(df):
    """Every fifth attempt without its user."""
    return df.withColumn("lti_user_id", F.when(F.col("event_id") % 5 != 0, F.col("lti_user_id")))


@register("agg_new_users_nulls", NEW_USERS_SQL.replace("from attempts ", "from partly ").replace(WA, WA + """,
partly as (select * exclude (lti_user_id), case when event_id % 5 <> 0 then lti_user_id end lti_user_id from attempts)"""))
def agg_new_users_nulls(spark, sf):
    """J2 where user ids are missing: such rows count as attempts, not as a user."""
    return A.new_users(_some_without_user(att(spark, sf)), str(WS), str(WE))


@register("agg_new_users_from_dim", NEW_USERS_SQL)
def agg_new_users_from_dim(spark, sf):
    """J2 as scheduled runs do it: the users dimension (first activity, kept by
    insert-ignore) takes the place of all earlier attempts."""
    a, path = att(spark, sf), scratch_path(spark, "users")
    for start, end in (("1970-01-01", str(WS)), (str(WS), str(WE))):
        W.insert_ignore(spark, A.first_activity(a, start, end), path, ["lti_user_id"], ["first_activity"])
    return A.new_users_from_dim(a, W.read_table(spark, path), str(WS), str(WE))

# ------------------------------------------------------------------ purchases

register("agg_daily_revenue_by_plan", with_(PURCHASES) + f"""
select date '{DS_ORDERS}' purchase_date, cast(sum(price) as decimal(18,2)) total_revenue,
       cast(sum(case when subscription_plan = 'month' then price else 0 end) as decimal(18,2))
         revenue_monthly_plan,
       cast(sum(case when subscription_plan = 'year' then price else 0 end) as decimal(18,2))
         revenue_yearly_plan,
       cast(sum(case when subscription_plan = 'trial' then price else 0 end) as decimal(18,2))
         revenue_trial,
       count(*) total_purchases
from purchases where purchase_date = date '{DS_ORDERS}' and status = 'success'""")(
    lambda spark, sf: A.daily_revenue_by_plan(T.purchases(spark, sf), DS_ORDERS))

register("agg_payment_method", with_(PURCHASES) + f"""
select purchase_date, payment_method, count(*) total_purchases,
       cast(sum(price) as decimal(15,2)) total_amount
from purchases where purchase_date = date '{DS_ORDERS}' and status = 'success' group by 1, 2""")(
    lambda spark, sf: A.payment_method(T.purchases(spark, sf), DS_ORDERS))

# ------------------------------------------------------------------------ café


def cafe_day(spark, sf, ds=DS_CAFE):
    from ..functions import calendar as cal
    return T.cafe_orders(spark, sf, period=cal.period_bounds("day", ds))


WC = with_(CAFE)
register("agg_revenue_by_branch", WC + f"""
select report_date, branch, count(*) orders_count, cast(sum(amount) as decimal(14,2))
       total_revenue
from cafe where report_date = date '{DS_CAFE}' group by 1, 2""")(
    lambda spark, sf: A.revenue_by_branch(cafe_day(spark, sf)))

register("agg_top_dishes", WC + f"""
select report_date, dish, cast(sum(qty) as bigint) total_qty,
       cast(sum(amount) as decimal(14,2)) total_revenue
from cafe where report_date = date '{DS_CAFE}' group by 1, 2 order by total_revenue desc""")(
    lambda spark, sf: A.top_dishes(cafe_day(spark, sf)))

# S4 — the three best-selling of the ranking; ties by name
register("agg_top_dishes_limit", WC + f"""
select report_date, dish, cast(sum(qty) as bigint) total_qty,
       cast(sum(amount) as decimal(14,2)) total_revenue
from cafe where report_date = date '{DS_CAFE}' group by 1, 2 order by total_revenue desc, dish limit 3""")(
    lambda spark, sf: A.top_dishes(cafe_day(spark, sf), 3))

register("agg_stats_by_category", WC + f"""
select report_date, category, cast(sum(qty) as bigint) total_qty,
       cast(sum(amount) as decimal(14,2)) total_revenue,
       {AVG('sum(price)', 'count(price)')} avg_price
from cafe where report_date = date '{DS_CAFE}' group by 1, 2""")(
    lambda spark, sf: A.stats_by_category(cafe_day(spark, sf)))

register("agg_sum_by_product", WC + f"""
select dish product, cast(sum(qty) as bigint) amount, date '{DS_CAFE}' load_date
from cafe group by 1""")(
    lambda spark, sf: A.sum_by_product(T.cafe_orders(spark, sf), DS_CAFE))

register("agg_avg_price_by_category", WC + f"""
select category category_name, {AVG('sum(price)', 'count(price)')} avg_price,
       date '{DS_SALES}' load_date
from cafe where report_date >= date '{DS_SALES}' group by 1""")(
    lambda spark, sf: A.avg_price_by_category(T.sales(spark, sf), DS_SALES))

register("agg_sales_by_manager", WC + f"""
select manager_name, count(*) total_sales, date '{DS_SALES}' load_date
from cafe where report_date >= date '{DS_SALES}' group by 1""")(
    lambda spark, sf: A.sales_by_manager(T.sales(spark, sf), DS_SALES))

# ---------------------------------------------------------------------- series

register("agg_sum_by_category", with_(SERIES) + """
select category, cast(sum(amount) as decimal(38,0)) sum_amount from series group by 1""")(
    lambda spark, sf: A.sum_by_category(T.series(spark, sf)))

register("agg_integer_average", with_(SERIES) + """
select category, cast(sum(amount) // count(*) as bigint) average_amount from series group by 1""")(
    lambda spark, sf: A.integer_average(T.series(spark, sf)))

register("agg_rounded_average", with_(SERIES) + f"""
select category, cast({R('sum(amount)', 'count(*)', scale=0, precision=18)} as bigint) amount,
       date '{DS}' load_date
from series group by 1""")(
    lambda spark, sf: A.rounded_average(T.series(spark, sf), DS))

register("src_generated_series", with_(SERIES) + "select id, category, amount from series")(
    lambda spark, sf: T.series(spark, sf))

# ----------------------------------------------------------------- catalogue

register("join_category_stock", """
with products as (select p_partkey product_id, p_brand category_id, p_size units_in_stock
                  from part),
     categories as (select distinct p_brand category_id,
                           regexp_replace(p_brand, '^Brand#', 'Category ') category_name
                    from part)
select category_name, cast(sum(units_in_stock) as bigint) units_in_stock, count(*) products
from products join categories using (category_id) group by 1""")(
    lambda spark, sf: A.category_stock(T.products(spark, sf), T.categories(spark, sf)))
