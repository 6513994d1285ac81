"""Registered queries for sources, normalisation (P1–P9), filters
and export ordering (S1, S2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.params import with_parsed_params
from ..operators import aggregates as A
from ..operators import filters as flt
from ..operators import normalize as N
from ..operators import writes as W
from ..sources import records as R
from ..sources import tables as T
from ..session import scratch_path
from .params import DS, DS_MONTH, month_start, next_month, plus, week_start
from .registry import ATTEMPTS, RECORDS, register, with_

WA = with_(ATTEMPTS)
WR = with_(RECORDS)
WS, WE = week_start(DS), plus(week_start(DS), 7)
RAW_COLS = "event_id, lti_user_id, attempt_type, created_at, is_correct"


def att(spark, sf):
    return T.attempts(spark, sf)


def raw(df):
    return df.select("event_id", "lti_user_id", "attempt_type", "created_at", "is_correct")


def rng(s, e, col="created_at"):
    return f"{col} >= timestamp '{s}' and {col} < timestamp '{e}'"


# ------------------------------------------------------------------ sources

register("src_full_scan", "select * from events")(
    lambda spark, sf: T.read_table(spark, sf, "events"))

register("src_column_subset", "select event_id, user_id, ts from events")(
    lambda spark, sf: T.column_subset(T.read_table(spark, sf, "events"),
                                      ["event_id", "user_id", "ts"]))

CANON_SQL = """event_id, lti_user_id, coalesce(raw_correct = 1, false) is_correct,
       event_type attempt_type, ts created_at, oauth_consumer_key, lis_result_sourcedid,
       lis_outcome_service_url"""


@register("src_attempt_records", WR + f"select {CANON_SQL} from records where {rng(WS, WE, 'ts')}")
def src_attempt_records(spark, sf):
    """SRC1: records land as JSON files; read back for one week and normalised."""
    path = scratch_path(spark, "landing")
    R.api_records(spark, sf).write.mode("overwrite").json(path)
    return N.normalize_attempts(R.read_attempts(spark, path, WS, WE))


# ----------------------------------------------------------- normalisation

register("normalize_attempts", WR + f"select {CANON_SQL} from records")(
    lambda spark, sf: N.normalize_attempts(R.api_records(spark, sf)))


def _flag(conv):
    def run(spark, sf):
        r = R.api_records(spark, sf)
        return N.normalize_attempts(r, correct=conv).select(
            "event_id", F.col("is_correct").alias("flag"))
    return run


register("correct_null_as_false", WR + """
select event_id, coalesce(raw_correct = 1, false) flag from records""")(_flag("null_as_false"))
register("correct_truthy", WR + """
select event_id, coalesce(raw_correct <> 0, false) flag from records""")(_flag("truthy"))
register("correct_three_valued", WR + """
select event_id, raw_correct <> 0 flag from records""")(_flag("three_valued"))

PARSED_SQL = """event_id, oauth_consumer_key, lis_result_sourcedid, lis_outcome_service_url,
       lesson_id, inner_score score, graded"""

register("parse_params_strict", WR + f"select {PARSED_SQL} from records")(
    lambda spark, sf: N.parsed_params(R.api_records(spark, sf), strict=True))

# corrupt rows ('error' with value < 1) parse to an empty dict
register("parse_params_lenient", WR + """
select event_id,
  case when bad then null else oauth_consumer_key end oauth_consumer_key,
  case when bad then null else lis_result_sourcedid end lis_result_sourcedid,
  case when bad then null else lis_outcome_service_url end lis_outcome_service_url,
  case when bad then null else lesson_id end lesson_id,
  case when bad then null else inner_score end score,
  case when bad then null else graded end graded
from (select *, event_type = 'error' and value < 1 bad from records)""")(
    lambda spark, sf: N.parsed_params(R.api_records(spark, sf, corrupt=True), strict=False))


def _scores(spark, sf, fn):
    r = with_parsed_params(R.api_records(spark, sf))
    return r.select("event_id", fn(F.col("_params.score"), F.col("score"), F.col("_params_json"))
                    .alias("score"))


register("score_falsy_fallback", WR + """
select event_id, coalesce(nullif(inner_score, 0), outer_score) score from records""")(
    lambda spark, sf: _scores(spark, sf, lambda i, o, t: N.score_falsy_fallback(i, o)))

register("score_key_presence", WR + """
select event_id, case when event_type <> 'click' then inner_score
                      else nullif(outer_score, 0) end score from records""")(
    lambda spark, sf: _scores(spark, sf, lambda i, o, t: N.score_key_presence(t, i, o)))

register("stamp_periods", WA + """
select event_id, cast(created_at as date) ds,
       cast(date_trunc('week', created_at) as date) week_start,
       cast(date_trunc('week', created_at) as date) + 6 week_end,
       cast(date_trunc('month', created_at) as date) month_start,
       last_day(created_at) month_end, strftime(created_at, '%Y-%m') month_period,
       strftime(date_trunc('week', created_at), '%Y-%m-%d') || '-' ||
         strftime(cast(date_trunc('week', created_at) as date) + 6, '%Y-%m-%d') period_label,
       upper(strftime(created_at, '%b')) || cast(year(created_at) as varchar) date_tag,
       cast(created_at as date) load_date
from attempts""")(
    lambda spark, sf: N.stamp_periods(att(spark, sf).select("event_id", "created_at"))
    .drop("created_at"))

register("export_projection", WR + """
select lti_user_id user_id, event_type "type", ts created_at,
       coalesce(raw_correct = 1, false) correct from records""")(
    lambda spark, sf: N.export_projection(
        N.normalize_attempts(R.api_records(spark, sf)),
        {"lti_user_id": "user_id", "attempt_type": "type", "created_at": "created_at",
         "is_correct": "correct"}, order_by=["user_id", "type", "created_at"]))

register("export_row_document", WA + f"""
select strftime(date '{DS}', '%Y-%m-%d') week_start,
       strftime(date '{plus(DS, 6)}', '%Y-%m-%d') week_end,
       count(*) total_attempts,
       cast(sum(case when is_correct then 1 else 0 end) as bigint) correct_attempts,
       coalesce(cast(sum(case when is_correct then 1 else 0 end) as double)
         / nullif(cast(count(*) as double), 0) * 100.0, 0.0) success_rate,
       count(distinct lti_user_id) unique_users,
       coalesce(cast(count(*) as double) / nullif(cast(count(distinct lti_user_id) as double), 0),
         0.0) attempts_per_user_avg,
       strftime(min(created_at), '%Y-%m-%d %H:%M:%S.%f') min_created_at,
       strftime(max(created_at), '%Y-%m-%d %H:%M:%S.%f') max_created_at,
       '{DS}' calculated_at
from attempts where {rng(DS, plus(DS, 7))}""")(
    lambda spark, sf: N.export_row_document(
        A.weekly_global(att(spark, sf), DS), DS,
        ratio_cols=("success_rate", "attempts_per_user_avg")))

# A19a over the normalised records: the NULL source id is a group of its own
register("agg_count_by_attribute", WR + """
select lis_result_sourcedid, count(*) total_rows from records group by 1""")(
    lambda spark, sf: A.count_by_attribute(
        N.normalize_attempts(R.api_records(spark, sf)), "lis_result_sourcedid"))

# ------------------------------------------------------------------ filters

register("filter_day", WA + f"select {RAW_COLS} from attempts where {rng(DS, plus(DS, 1))}")(
    lambda spark, sf: raw(flt.filter_day(att(spark, sf), DS)))

register("filter_rolling_week", WA + f"""
select {RAW_COLS} from attempts where {rng(DS, plus(DS, 7))}""")(
    lambda spark, sf: raw(flt.filter_rolling_week(att(spark, sf), DS)))

register("filter_calendar_week", WA + f"select {RAW_COLS} from attempts where {rng(WS, WE)}")(
    lambda spark, sf: raw(flt.filter_calendar_week(att(spark, sf), DS)))

MS, ME = month_start(DS_MONTH), next_month(DS_MONTH)
register("filter_calendar_month", WA + f"select {RAW_COLS} from attempts where {rng(MS, ME)}")(
    lambda spark, sf: raw(flt.filter_calendar_month(att(spark, sf), DS_MONTH)))

register("filter_week_closed_second", WA + f"""
select {RAW_COLS} from attempts
where created_at >= timestamp '{WS}' and created_at <= timestamp '{plus(WS, 6)} 23:59:59'""")(
    lambda spark, sf: raw(flt.filter_week_closed_second(att(spark, sf), DS)))

# F13 keeps rows up to the month's last day at 00:00 and loses the rest of
# that day; the events end on 01-30, so the loss shows in the boundary-instant
# unit test (tests/test_calendar.py), not here.
register("filter_month_closed_midnight", WA + f"""
select {RAW_COLS} from attempts
where created_at >= timestamp '{MS}' and created_at <= timestamp '{plus(ME, -1)}'""")(
    lambda spark, sf: raw(flt.filter_month_closed_midnight(att(spark, sf), DS_MONTH)))


@register("filter_period_stamp", WA + f"""
select {RAW_COLS}, cast(created_at as date) ds from attempts
where cast(created_at as date) = date '{DS}'""")
def filter_period_stamp(spark, sf):
    """rows stamped with ds, written partitioned by ds; the equality on
    the stamp prunes to one partition folder."""
    path = scratch_path(spark, "stamped")
    stamped = raw(att(spark, sf)).withColumn("ds", F.col("created_at").cast("date"))
    W.write_full_refresh(stamped, path, ["ds"])
    t = W.read_table(spark, path)
    return flt.filter_stamp(t, ds=DS).select(*stamped.columns)


@register("filter_agg_by_date", WA + f"""
select cast(created_at as date) ds, attempt_type, count(*) attempts,
       cast(sum(case when is_correct then 1 else 0 end) as bigint) correct
from attempts where {rng(WS, WE)} group by 1, 2""")
def filter_agg_by_date(spark, sf):
    """The daily aggregate table of all days, cut to one week by its own date."""
    daily = A.daily_by_type_range(att(spark, sf), "1970-01-01", "9999-01-01")
    return flt.in_range(daily, "ds", WS, WE)


# ------------------------------------------------------------------- sorts

register("sort_export_raw", WA + f"select {RAW_COLS} from attempts where {rng(WS, WE)}")(
    lambda spark, sf: raw(flt.filter_calendar_week(att(spark, sf), DS)).orderBy("created_at",
                                                                                "event_id"))


@register("src_synthetic_orders", """
with days as (select distinct cast(l_shipdate as date) report_date from lineitem),
     menu(dish, category, price) as (values {menu}),
     branches(branch) as (values {branches}),
     x as (select *, ('0x' || substr(md5(cast(report_date as varchar) || branch || dish), 1, 8))::bigint % 36 + 5 q
           from days, branches, menu)
select report_date, branch, dish, category, price, cast(q as bigint) qty,
       cast(q * price as decimal(12,2)) amount from x""".format(
    menu=", ".join(f"('{d}', '{c}', cast({p} as decimal(10,2)))" for d, c, p in R.CAFE_MENU),
    branches=", ".join(f"('{b}')" for b in R.CAFE_BRANCHES)))
def src_synthetic_orders(spark, sf):
    """SRC6: the fixed branch × menu list expanded for every distinct ship date of lineitem."""
    days = (T.read_table(spark, sf, "lineitem")
            .select(F.col("l_shipdate").cast("date").alias("report_date")).distinct())
    return R.synthetic_orders(days)


@register("src_all_strings", WR + f"""
select cast(event_id as varchar) event_id, lti_user_id, cast(raw_correct as varchar) is_correct,
       event_type attempt_type, cast(outer_score as varchar) score,
       date '{WS}' _period_start, date '{plus(WS, 6)}' _period_end from records""")
def src_all_strings(spark, sf):
    """SRC4: records landed as JSON, their columns inferred and read as text."""
    path = scratch_path(spark, "strings")
    R.api_records(spark, sf).write.option("ignoreNullFields", "false").json(path)
    return R.read_all_strings(spark, path, WS, plus(WS, 6)).select(
        "event_id", "lti_user_id", "is_correct", "attempt_type", "score", "_period_start", "_period_end")


@register("src_rare_keys", """
select cast(event_id as varchar) event_id,
       case when event_id = (select max(event_id) from events) then 'seen once' end rare from events""")
def src_rare_keys(spark, sf):
    """SRC4: a key that occurs in one record only becomes a column of all."""
    path, ev = scratch_path(spark, "rare"), T.read_table(spark, sf, "events")
    last = ev.agg(F.max("event_id")).first()[0]
    ev.select("event_id", F.when(F.col("event_id") == last, "seen once").alias("rare")).write.json(path)
    return R.read_all_strings(spark, path, WS, plus(WS, 6)).select("event_id", "rare")


@register("normalize_lessons", WR + f"""
select {CANON_SQL}, lesson_id, lesson_name, coalesce(nullif(inner_score, 0), outer_score) score from records""")
def normalize_lessons(spark, sf):
    """P1 + P3c + P4a: the lesson variant, with the lesson's own name and a score
    that may be '', None, 0 or missing."""
    return N.normalize_attempts(R.api_records(spark, sf), lesson=True)


register("agg_count_by_user", WR + "select lti_user_id, count(*) total_rows from records group by 1")(
    lambda spark, sf: A.count_by_attribute(N.normalize_attempts(R.api_records(spark, sf)), "lti_user_id"))

register("agg_count_by_url", WR + """
select lis_outcome_service_url, count(*) total_rows from records group by 1""")(
    lambda spark, sf: A.count_by_attribute(
        N.normalize_attempts(R.api_records(spark, sf)), "lis_outcome_service_url"))

# ------------------------------------------------- rows on period boundaries
# Every tenth attempt is moved to the last half second of its week, every
# tenth to noon of its month's last day, so that the closed ranges F12 and F13
# differ from the half-open F3 and F4.

EDGE = with_(ATTEMPTS) + f""", edge as (select * replace (case event_id % 10
    when 0 then date_trunc('week', created_at) + interval 7 day - interval 500 millisecond
    when 1 then last_day(created_at) + interval 12 hour else created_at end as created_at) from attempts)
select {RAW_COLS} from edge where """


def edge_attempts(spark, sf):
    a, t = att(spark, sf), F.col("created_at")
    last = F.date_trunc("week", t).cast("timestamp_ntz") + F.expr("INTERVAL 7 DAYS") - F.expr("INTERVAL 0.5 SECOND")
    noon = F.last_day(t).cast("timestamp_ntz") + F.expr("INTERVAL 12 HOURS")
    e = F.pmod("event_id", F.lit(10))
    return raw(a.withColumn("created_at", F.when(e == 0, last).when(e == 1, noon).otherwise(t)))


register("edge_calendar_week", EDGE + rng(WS, WE))(
    lambda spark, sf: flt.filter_calendar_week(edge_attempts(spark, sf), DS))
register("edge_week_closed_second", EDGE + f"""
created_at >= timestamp '{WS}' and created_at <= timestamp '{plus(WS, 6)} 23:59:59'""")(
    lambda spark, sf: flt.filter_week_closed_second(edge_attempts(spark, sf), DS))
register("edge_calendar_month", EDGE + rng(MS, ME))(
    lambda spark, sf: flt.filter_calendar_month(edge_attempts(spark, sf), DS_MONTH))
register("edge_month_closed_midnight", EDGE + f"""
created_at >= timestamp '{MS}' and created_at <= timestamp '{plus(ME, -1)}'""")(
    lambda spark, sf: flt.filter_month_closed_midnight(edge_attempts(spark, sf), DS_MONTH))
