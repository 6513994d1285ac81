"""Registered queries for write modes (W1–W8, J3–J6), sinks (X1–X9) with
read-back, quality checks (Q1–Q7) and the config runner (C1–C5).

Each query performs its writes into a fresh folder under the shared work
folder and returns the table as read back, so the result reflects what the
write mode left on storage.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as TT

from ..functions import calendar as cal
from ..functions.ratios import duck_half_up as R
from ..operators import aggregates as A
from ..operators import filters as flt
from ..operators import joins as J
from ..operators import normalize as N
from ..operators import quality as Q
from ..operators import sinks as X
from ..operators import writes as W
from ..session import scratch_path
from ..sources import records as REC
from ..sources import tables as T
from . import specs as S
from .params import DS, DS_MONTH, DS_NEXT_WEEK, DS_ORDERS, plus, week_start
from .q_aggregates import WEEKLY_USER_TYPE_SQL
from .registry import ATTEMPTS, RECORDS, register, with_

WA = with_(ATTEMPTS)
WS, WE = week_start(DS), plus(week_start(DS), 7)
RAW = ["event_id", "lti_user_id", "attempt_type", "created_at", "is_correct"]
RAW_SQL = ", ".join(RAW)


def att(spark, sf):
    return T.attempts(spark, sf)


def rng(s, e, col="created_at"):
    return f"{col} >= timestamp '{s}' and {col} < timestamp '{e}'"


def with_late_copies(df):
    """The batch plus a later-arriving copy of every 'click' row: same
    (user, created_at) key, a later event id and a different payload."""
    copies = (df.filter(F.col("attempt_type") == "click")
              .withColumn("event_id", F.col("event_id") + F.lit(1_000_000_000))
              .withColumn("attempt_type", F.lit("click_copy")))
    return df.unionByName(copies)


KEYS = ["lti_user_id", "created_at"]
WEEKS5 = [str(plus("2024-01-01", 7 * k)) for k in range(5)]          # every week that has events

# ------------------------------------------------------------------ joins


@register("anti_new_rows", WA + f"select {RAW_SQL} from attempts where created_at >= timestamp '2024-01-12'")
def anti_new_rows(spark, sf):
    """All attempts with late copies vs a target holding rows before 01-12."""
    a = T.attempts(spark, sf).select(*RAW)
    return J.anti_new_rows(with_late_copies(a), flt.filter_before(a, "2024-01-12"), KEYS, ["event_id"])


@register("anti_new_rows_bucketed", WA + f"""
select {RAW_SQL} from attempts where created_at >= timestamp '2024-01-12'""")
def anti_new_rows_bucketed(spark, sf):
    """J3 against a table bucketed by the key: the table is not shuffled."""
    a, path = T.attempts(spark, sf).select(*RAW), scratch_path(spark, "bucketed")
    W.write_append(flt.filter_before(a, "2024-01-12"), path, bucket_by=(8, KEYS))
    return J.anti_new_rows(with_late_copies(a), W.read_table(spark, path), KEYS, ["event_id"])


@register("insert_ignore_own_days", WA + f"select {RAW_SQL}, cast(created_at as date) ds from attempts")
def insert_ignore_own_days(spark, sf):
    """W5 with the table's partitions taken from the batch: of a table by day,
    each week's batch reads that week only; the last is sent again with late copies."""
    a, path = T.attempts(spark, sf).select(*RAW), scratch_path(spark, "own_days")
    for w in WEEKS5:
        week = flt.in_range(a, "created_at", w, plus(w, 7)).withColumn("ds", F.col("created_at").cast("date"))
        for batch in [with_late_copies(week)] + [with_late_copies(week)] * (w == WEEKS5[-1]):
            W.insert_ignore(spark, batch, path, KEYS, ["event_id"], ["ds"], partitions_follow_key=True)
    return W.read_table(spark, path)


@register("dedup_first_wins", WA + f"select {RAW_SQL} from attempts")
def dedup_first_wins(spark, sf):
    """Insert-ignore of all attempts with late copies into a table that
    already holds those before 01-11; first arrival per key wins."""
    a = T.attempts(spark, sf).select(*RAW)
    path = scratch_path(spark, "insert_ignore")
    W.write_append(flt.filter_before(a, plus(WS, 3)), path)
    W.insert_ignore(spark, with_late_copies(a), path, KEYS, ["event_id"])
    return W.read_table(spark, path)


MONTH_SQL = """
select lti_user_id, attempt_type, count(*) total_attempts,
       count(case when is_correct then 1 end) correct_attempts,
       count(case when not is_correct then 1 end) incorrect_attempts,
       {avg} avg_score, max(score) max_score, min(score) min_score,
       min(created_at) first_attempt_date, max(created_at) last_attempt_date,
       '2024-01' year_month, date '{load}' load_date
from attempts where {where} group by 1, 2"""


def _month_sql(where, load):
    from ..functions.ratios import duck_half_up_avg
    return MONTH_SQL.format(avg=duck_half_up_avg("sum(score)", "count(score)"), where=where,
                            load=load)


@register("upsert_result", WA + "select * from (" + _month_sql(
    "created_at >= timestamp '2024-01-01' and created_at < timestamp '2024-01-20'",
    "2024-01-19") + ") snap where attempt_type not in ('click', 'view') union all "
    "select * from (" + _month_sql("created_at >= timestamp '2024-01-01' and created_at < "
                                   "timestamp '2024-02-01'", DS_MONTH) +
    ") full_month where attempt_type in ('click', 'view')")
def upsert_result(spark, sf):
    """Monthly table upserted by (user, type, month): first with the
    month-to-date snapshot, then the full month for two types only."""
    a = att(spark, sf)
    path = scratch_path(spark, "upsert")
    keys = ["lti_user_id", "attempt_type", "year_month"]
    snap = A.monthly_user_attempts(flt.filter_before(a, "2024-01-20"), "2024-01-19")
    W.upsert(spark, snap, path, keys, ["year_month"])
    full = A.monthly_user_attempts(a, DS_MONTH).filter(F.col("attempt_type").isin("click", "view"))
    W.upsert(spark, full, path, keys, ["year_month"])
    return W.read_table(spark, path).select(*snap.columns)


@register("upsert_moved_partition", WA + """
select lti_user_id, max(created_at) last_seen, cast(max(created_at) as date) last_day,
       arg_max(attempt_type, created_at) last_type
from attempts group by 1""")
def upsert_moved_partition(spark, sf):
    """W4 where the key moves: one row per user in the partition of their last
    day, first as of 01-12, then as of all events; no user stays twice."""
    path = scratch_path(spark, "moved")
    a = att(spark, sf)
    for rows in (flt.filter_before(a, "2024-01-12"), a):
        W.upsert(spark, A.last_seen(rows), path, ["lti_user_id"], ["last_day"])
    return W.read_table(spark, path).select("lti_user_id", "last_seen", "last_day", "last_type")


WEEK_TOTALS_SQL = """
select cast(date_trunc('week', created_at) as date) period_start, count(*) attempts,
       count(distinct lti_user_id) unique_users from attempts group by 1"""


def _week_totals(df, start):
    return flt.in_range(df, "created_at", start, plus(start, 7)).groupBy(
        cal.as_date(start).alias("period_start")).agg(
        F.count(F.lit(1)).alias("attempts"), F.count_distinct("lti_user_id").alias("unique_users"))


@register("insert_if_period_absent", WA + WEEK_TOTALS_SQL)
def insert_if_period_absent(spark, sf):
    """Totals of every week inserted only for weeks not loaded yet; a
    second, different load of the second week is skipped."""
    a = att(spark, sf)
    path = scratch_path(spark, "period_absent")
    clicks_only = a.filter(F.col("attempt_type") == "click")
    loads = [(a, w) for w in WEEKS5[:3]] + [(clicks_only, WEEKS5[1])] + [(a, w) for w in WEEKS5[3:]]
    for rows, w in loads:
        W.insert_if_period_absent(spark, _week_totals(rows, w), path, "period_start", w)
    return W.read_table(spark, path)


@register("load_if_partition_empty", WA + """
select cast(created_at as date) ds, attempt_type, count(*) attempts,
       cast(sum(case when is_correct then 1 else 0 end) as bigint) correct
from attempts group by 1, 2""")
def load_if_partition_empty(spark, sf):
    """A created table gets the days before 01-15, refuses a load that
    overlaps them, and gets the rest."""
    path = scratch_path(spark, "w7")
    daily = A.daily_by_type_range(att(spark, sf), "1970-01-01", "9999-01-01")
    W.create_if_missing(spark, path, daily.schema, ["ds"])
    W.load_if_partition_empty(spark, flt.filter_before(daily, "2024-01-15", "ds"), path, ["ds"])
    W.load_if_partition_empty(spark, flt.filter_since(daily, "2024-01-14", "ds"), path, ["ds"])
    W.load_if_partition_empty(spark, flt.filter_since(daily, "2024-01-15", "ds"), path, ["ds"])
    return W.read_table(spark, path).select(*daily.columns)


# ------------------------------------------------------------- write modes

ALL_DAYS_SQL = """
select cast(created_at as date) ds, attempt_type, count(*) attempts,
       cast(sum(case when is_correct then 1 else 0 end) as bigint) correct
from attempts group by 1, 2"""


def _all_days(spark, sf):
    return A.daily_by_type_range(att(spark, sf), "1970-01-01", "9999-01-01")


@register("write_append_twice", WA + f"select * from ({ALL_DAYS_SQL}) union all select * from ({ALL_DAYS_SQL})")
def write_append_twice(spark, sf):
    """A re-run of an append load duplicates the rows."""
    path = scratch_path(spark, "append")
    for _ in range(2):
        W.write_append(_all_days(spark, sf), path)
    return W.read_table(spark, path)


@register("write_append_aligned", WA + f"select * from ({ALL_DAYS_SQL}) union all select * from ({ALL_DAYS_SQL})")
def write_append_aligned(spark, sf):
    """A batch with the same columns in another order is matched by name,
    and one that lacks a column is refused, so older rows keep theirs."""
    path, days = scratch_path(spark, "aligned"), _all_days(spark, sf)
    W.write_append(days, path)
    W.write_append(days.select(*reversed(days.columns)), path)
    try:
        W.write_append(days.drop("correct"), path)
    except ValueError:
        return W.read_table(spark, path)
    raise AssertionError("a narrower batch was appended")


@register("write_full_refresh", WA + ALL_DAYS_SQL)
def write_full_refresh(spark, sf):
    """TRUNCATE + INSERT — of a partial and a full load only the second remains."""
    path = scratch_path(spark, "refresh")
    days = _all_days(spark, sf)
    W.write_full_refresh(flt.filter_before(days, "2024-01-15", "ds"), path)
    W.write_full_refresh(days, path)
    return W.read_table(spark, path)


DAILY_RANGE_SQL = WA + """
select cast(created_at as date) ds, attempt_type, count(*) attempts,
       cast(sum(case when is_correct then 1 else 0 end) as bigint) correct
from attempts where {where} group by 1, 2"""


def _days_table(spark, df, path, start, end):
    daily = A.daily_by_type_range(df, start, end)
    W.replace_periods(spark, daily, path, ["ds"],
                      periods=[{"ds": str(plus(start, i))}
                               for i in range((cal_date(end) - cal_date(start)).days)])


def cal_date(s):
    from .params import d
    return d(str(s))


@register("write_period_replace", DAILY_RANGE_SQL.format(where=rng(WS, WE)))
def write_period_replace(spark, sf):
    """The week is loaded mid-week (rows before 01-12 12:00), then days
    01-11 .. 01-14 are re-run on complete data; no partial rows remain."""
    a = att(spark, sf)
    path = scratch_path(spark, "replace")
    partial = a.filter(F.col("created_at") < F.lit("2024-01-12 12:00:00").cast("timestamp_ntz"))
    _days_table(spark, partial, path, WS, WE)
    _days_table(spark, a, path, "2024-01-11", WE)
    return W.read_table(spark, path).select("ds", "attempt_type", "attempts", "correct")


@register("write_period_replace_empty", DAILY_RANGE_SQL.format(
    where=rng(WS, WE) + " and cast(created_at as date) <> date '2024-01-13'"))
def write_period_replace_empty(spark, sf):
    """W3 with an empty source: re-running 01-13 on no rows empties that day
    (DELETE + INSERT semantics), unlike a bare dynamic overwrite."""
    a = att(spark, sf)
    path = scratch_path(spark, "replace_empty")
    _days_table(spark, a, path, WS, WE)
    gone = a.filter(F.col("attempt_type") == "no-such-type")
    _days_table(spark, gone, path, "2024-01-13", "2024-01-14")
    return W.read_table(spark, path).select("ds", "attempt_type", "attempts", "correct")


@register("write_period_replace_timestamp", WA + """
select lti_user_id, attempt_type, count(*) attempt_count,
       count(case when is_correct then null else 1 end) attempt_failed_count,
       cast(date_trunc('week', created_at) as timestamp) "date"
from attempts where cast(date_trunc('week', created_at) as date) <> date '2024-01-15' group by 1, 2, 5""")
def write_period_replace_timestamp(spark, sf):
    """W3 on a TIMESTAMP stamp: every week is loaded; the week of 01-15, given
    as a date, is re-run on no rows and empties."""
    a, path = att(spark, sf), scratch_path(spark, "replace_ts")
    for w in WEEKS5:
        W.replace_periods(spark, A.weekly_user_type(a, w), path, ["date"], [{"date": w}])
    none = A.weekly_user_type(a.filter(F.col("attempt_type") == "no-such-type"), "2024-01-15")
    W.replace_periods(spark, none, path, ["date"], [{"date": "2024-01-15"}])
    return W.read_table(spark, path).select(*none.columns)


@register("write_range_replace", WA + f"""
select {RAW_SQL}, cast(created_at as date) ds from attempts
where created_at < timestamp '2024-01-10 06:00:00' or created_at >= timestamp '2024-01-12 18:00:00'
   or attempt_type = 'click'""")
def write_range_replace(spark, sf):
    """Of all attempts by day, those from 01-10 06:00 to 01-12 18:00 are
    replaced by their clicks; what is left of the first and last day stays."""
    a = T.attempts(spark, sf).select(*RAW).withColumn("ds", F.col("created_at").cast("date"))
    path, start, end = scratch_path(spark, "range"), "2024-01-10 06:00:00", "2024-01-12 18:00:00"
    W.write_append(a, path, ["ds"])
    clicks = a.filter(F.col("created_at").between(F.lit(start).cast("timestamp_ntz"),
                                                  F.lit(end).cast("timestamp_ntz") - F.expr("interval 1 microsecond"))
                      & (F.col("attempt_type") == "click"))
    W.write_range_replace(spark, clicks, path, "created_at", start, end, ["ds"])
    return W.read_table(spark, path)


@register("catalogue_tables", WA + """
select * from (values ('created', true, 0), ('dropped', false, null)) t(step, is_table, row_count)
union all select 'filled', true, count(*) from attempts
union all select 'without ' || cast(min(created_at) as date), true,
  count(*) filter (where cast(created_at as date) <> (select cast(min(created_at) as date) from attempts))
from attempts""")
def catalogue_tables(spark, sf):
    """A table is created, filled, loses its first day as a partition
    and is dropped, each step as the catalogue sees it."""
    a = T.attempts(spark, sf).select(*RAW).withColumn("ds", F.col("created_at").cast("date"))
    path, out = scratch_path(spark, "catalogue"), []
    name = W.table_name(path)

    def step(text):
        there = spark.catalog.tableExists(name)
        out.append((text, there, spark.table(name).count() if there else None))

    W.create_if_missing(spark, path, a.schema, ["ds"])
    step("created")
    W.write_append(a, path, ["ds"])
    step("filled")
    first = a.agg(F.min("ds")).first()[0]
    W.drop_partitions(spark, path, [(str(first),)])
    step(f"without {first}")
    W.drop_table(spark, path)
    step("dropped")
    return spark.createDataFrame(out, "step string, is_table boolean, row_count long")


@register("write_replace_ignore", WA + f"""
select {RAW_SQL}, cast(created_at as date) ds from attempts""")
def write_replace_ignore(spark, sf):
    """W3 + W5: days are loaded with late copies and re-run from 01-10 on; the
    first arrival of a key stays, and keys of other days are not taken twice."""
    path = scratch_path(spark, "replace_ignore")
    a = T.attempts(spark, sf).select(*RAW)
    days = [{"ds": str(plus("2024-01-01", i))} for i in range(31)]
    for rows, periods in ((with_late_copies(a), days),
                          (with_late_copies(flt.filter_since(a, DS, "created_at")), days[9:])):
        W.replace_periods_ignoring(spark, rows.withColumn("ds", F.col("created_at").cast("date")), path,
                                   ["ds"], periods, KEYS, ["event_id"])
    return W.read_table(spark, path)


@register("write_affected_rows", WA + "select count(*) affected from attempts")
def write_affected_rows(spark, sf):
    """Q10: the affected-row count of a write, observed while it runs."""
    df, seen = Q.observed(att(spark, sf), "affected")
    W.write_append(df, scratch_path(spark, "affected"))
    return spark.createDataFrame([(seen.get["rows"],)], "affected long")


# ------------------------------------------------------------------- sinks

@register("sink_tsv_roundtrip", WEEKLY_USER_TYPE_SQL)
def sink_tsv_roundtrip(spark, sf):
    """Tab-separated, no header, minimal quoting — read back with its schema."""
    df = A.weekly_user_type(att(spark, sf), DS)
    path = scratch_path(spark, "tsv")
    X.export_delimited(df, path)
    return X.read_delimited(spark, path, df.schema)


@register("sink_csv_header_roundtrip", WA + _month_sql(
    "created_at >= timestamp '2024-01-01' and created_at < timestamp '2024-02-01'", DS_MONTH))
def sink_csv_header_roundtrip(spark, sf):
    """Comma CSV with header (decimals, timestamps, text)."""
    df = A.monthly_user_attempts(att(spark, sf), DS_MONTH)
    path = scratch_path(spark, "csv")
    X.export_csv(df, path)
    return X.read_delimited(spark, path, df.schema, sep=",", header=True)


@register("sink_json_roundtrip", WA + f"""
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
from attempts where {rng(DS, plus(DS, 7))}""")
def sink_json_roundtrip(spark, sf):
    """X4 + P9: the weekly global row as a JSON document."""
    doc = N.export_row_document(A.weekly_global(att(spark, sf), DS), DS,
                                ratio_cols=("success_rate", "attempts_per_user_avg"))
    path = scratch_path(spark, "json")
    X.export_json(doc, path)
    return X.read_json(spark, path, doc.schema)


@register("sink_partitioned_roundtrip", DAILY_RANGE_SQL.format(where=rng(WS, WE)))
def sink_partitioned_roundtrip(spark, sf):
    """Export laid out as table/ds=YYYY-MM-DD/ folders."""
    df = A.daily_by_type_range(att(spark, sf), WS, WE)
    path = scratch_path(spark, "parts")
    X.export_delimited(df, path, partition_by=["ds"])
    back = X.read_delimited(spark, path, TT.StructType(
        [f for f in df.schema.fields if f.name != "ds"] + [TT.StructField("ds", TT.DateType())]))
    return back.select(*df.columns)


@register("sink_tsv_header_roundtrip", WA + ALL_DAYS_SQL)
def sink_tsv_header_roundtrip(spark, sf):
    """Tab-separated with header, written twice to the same place."""
    df, path = _all_days(spark, sf), scratch_path(spark, "tsv_header")
    for rows in (df.filter("attempts > 1"), df):
        X.export_delimited(rows, path, header=True)
    return X.read_delimited(spark, path, df.schema, header=True)


@register("sink_named_files", WA + f"""
select 'raw' kind, cast(count(*) as bigint) row_count from attempts
union all select 'agg', count(*) from ({ALL_DAYS_SQL})""")
def sink_named_files(spark, sf):
    """Raw rows and aggregate as named files, read back."""
    base = scratch_path(spark, "named")
    raw, agg = att(spark, sf).select(*RAW), _all_days(spark, sf)
    paths = X.export_pair(raw, agg, base, "attempts", DS)
    out = [X.read_delimited(spark, p.replace(".csv", "*.csv"), df.schema, sep=",", header=True)
           .agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("row_count"))
           for (kind, p), df in zip(paths.items(), (raw, agg))]
    return out[0].unionByName(out[1])


@register("sink_empty_policies", """
select * from (values ('write', true, 0), ('skip', false, null), ('fail', false, null))
  t(policy, written, row_count) union all
select 'rows', true, cast(count(*) as int) from events""")
def sink_empty_policies(spark, sf):
    """An export without rows is written empty, skipped or failed; one with
    rows is written whatever the policy."""
    ev = T.read_table(spark, sf, "events").select("event_id")
    none, out = ev.filter("event_id < -1"), []
    for policy, df in (("write", none), ("skip", none), ("fail", none), ("rows", ev)):
        path = scratch_path(spark, f"empty_{policy}")
        try:
            done = X.export_csv(df, path, on_empty="fail" if policy == "rows" else policy)
        except X.EmptyExportError:
            done = False
        n = spark.read.schema(ev.schema).option("header", "true").csv(path).count() if done else None
        out.append((policy, done, n))
    return spark.createDataFrame(out, "policy string, written boolean, row_count int")


@register("sink_period_rows", WA + f"""
select {RAW_SQL} from attempts where cast(created_at as date) = date '{DS}'""")
def sink_period_rows(spark, sf):
    """The rows of one run date out of a table of all, by created_at and,
    once stamped, by load_date (both must give the same)."""
    a = T.attempts(spark, sf).select(*RAW)
    by_time = X.period_rows_for_export(a, DS)
    stamped = a.withColumn("load_date", F.col("created_at").cast("date"))
    return X.period_rows_for_export(stamped, DS).drop("load_date").intersectAll(by_time)


# ----------------------------------------------------------------- quality

READY_COLS = "ready, sources_checked, sources_ready"


def _ready_sql(parts: list[str], agg: str) -> str:
    union = " union all ".join(parts)
    return f"""select {agg}(ready) ready, count(*) sources_checked,
       count(*) filter (where ready) sources_ready from ({union})"""


EV_DAY = f"select count(*) >= 1 ready from events where {rng(DS, plus(DS, 1), 'ts')}"
ORD_DAY = f"select count(*) >= 1 ready from orders where {rng(DS_ORDERS, plus(DS_ORDERS, 1), 'o_orderdate')}"
LI_DAY = f"select count(*) >= 1 ready from lineitem where {rng('1997-03-15', '1997-03-16', 'l_shipdate')}"


def _ev_day(spark, sf, day=DS):
    return flt.filter_day(att(spark, sf), day)


def _ord_day(spark, sf):
    return flt.filter_day(T.purchases(spark, sf), DS_ORDERS, "_purchase_ts")


def _li_day(spark, sf):
    return flt.filter_day(T.read_table(spark, sf, "lineitem"), "1997-03-15", "l_shipdate")


register("ready_single", _ready_sql([EV_DAY], "bool_and"))(
    lambda spark, sf: Q.ready(spark, {"events": _ev_day(spark, sf)}))

register("ready_all_tables", _ready_sql([EV_DAY, ORD_DAY, LI_DAY], "bool_and"))(
    lambda spark, sf: Q.ready(spark, {"events": _ev_day(spark, sf), "orders": _ord_day(spark, sf),
                                      "lineitem": _li_day(spark, sf)}))


@register("ready_any_table", _ready_sql([
    f"select count(*) >= 1 ready from events where {rng('2023-12-31', '2024-01-01', 'ts')}",
    "select false ready", ORD_DAY], "bool_or"))
def ready_any_table(spark, sf):
    """Q3: any of three sources ready; an absent table counts as not ready."""
    missing = T.table_path(sf, "attempts_archive")
    srcs = {"events_dec31": _ev_day(spark, sf, "2023-12-31"),
            "archive": spark.read.parquet(missing) if W.table_exists(spark, missing) else None,
            "orders": _ord_day(spark, sf)}
    return Q.ready(spark, srcs, mode="any")


def _probe_sql(parts: list[tuple[str, str]], stop: str) -> str:
    """The sources in order up to the first whose readiness is ``stop``."""
    rows = " union all ".join(f"select {i} i, '{name}' s, ({e}) r" for i, (name, e) in enumerate(parts))
    return f"""with p as ({rows}), seen as (select * from p where not exists
  (select 1 from p q where q.i < p.i and q.r = {stop}))
select arg_max(r, i) ready, count(*) sources_checked, arg_max(s, i) last_source from seen"""


@register("ready_in_order", "select * from (" + _probe_sql([
    ("events", "select count(*) >= 1000 from events"), ("none", "select count(*) >= 1000 from events where ts < timestamp '2000-01-01'"),
    ("lineitem", "select count(*) >= 1000 from lineitem")], "false") + ") union all select * from (" + _probe_sql([
        ("none", "select count(*) >= 1 from events where ts < timestamp '2000-01-01'"),
        ("orders", "select count(*) >= 1 from orders"), ("lineitem", "select false")], "true") + ")")
def ready_in_order(spark, sf):
    """Q2 / Q3 short-circuit: all of three sources with 1000 rows, and any of three with one; the last is not read."""
    ev = T.read_table(spark, sf, "events")
    none = ev.filter(F.col("ts") < F.lit("2000-01-01").cast("timestamp_ntz"))
    every = Q.ready_in_order(spark, {"events": ev, "none": none,
                                     "lineitem": lambda: T.read_table(spark, sf, "lineitem")}, 1000)
    any_of = Q.ready_in_order(spark, {"none": none, "orders": T.read_table(spark, sf, "orders"),
                                      "lineitem": lambda: T.read_table(spark, sf, "lineitem")}, mode="any")
    return every.unionByName(any_of)


@register("partition_empty", """
with b as (select cast(min(ts) as date) - 2 s, cast(max(ts) as date) + 2 e from events),
     spine as (select cast(unnest(generate_series(s, e, interval 1 day)) as date) ds from b),
     c as (select cast(ts as date) ds, count(*) n from events group by 1)
select spine.ds, coalesce(n, 0) row_count, coalesce(n, 0) = 0 is_empty
from spine left join c using (ds)""")
def partition_empty(spark, sf):
    """Q4: emptiness of every day partition from two days before the first
    event to two days after the last."""
    ev = T.read_table(spark, sf, "events")
    b = ev.agg(F.date_sub(F.min("ts").cast("date"), 2).alias("start"),
               F.date_add(F.max("ts").cast("date"), 2).alias("end"))
    spine = cal.date_spine(b, out_col="ds")
    return Q.partition_emptiness(ev.withColumn("ds", F.col("ts").cast("date")), spine, "ds")


register("dq_min_rows", """
select 'events' table_name, count(*) row_count, cast(1000 as bigint) min_rows,
       count(*) >= 1000 passed from events""")(
    lambda spark, sf: Q.min_rows_check(T.read_table(spark, sf, "events"), 1000, "events"))

NULL_LIMITS = {"lis_result_sourcedid": 1.0, "is_correct": 5.0, "score": 50.0}


@register("dq_null_pct", with_(RECORDS) + " union all ".join(
    f"""select '{c}' column_name, count(*) - count({e}) null_count,
       {R(f'count(*) - count({e})', 'count(*)', scale=2, times=100, precision=5)} null_pct,
       cast({lim} as double) max_null_pct,
       coalesce(cast({R(f'count(*) - count({e})', 'count(*)', scale=2, times=100, precision=5)}
                as double) <= {lim}, true) passed from records"""
    for c, e, lim in [("lis_result_sourcedid", "lis_result_sourcedid", 1.0),
                      ("is_correct", "raw_correct", 5.0),
                      ("score", "coalesce(nullif(inner_score, 0), outer_score)", 50.0)]))
def dq_null_pct(spark, sf):
    """Q6: NULL shares of three critical columns of the normalised lesson
    records, all from one aggregation pass."""
    recs = N.normalize_attempts(REC.api_records(spark, sf), correct="three_valued", lesson=True)
    return Q.null_pct(recs, NULL_LIMITS)


@register("dq_unique_key", WA + """
select lti_user_id, created_at, count(*) occurrences from (
  select lti_user_id, created_at from attempts
  union all
  select lti_user_id, created_at from attempts where attempt_type = 'click')
group by 1, 2 having count(*) > 1""")
def dq_unique_key(spark, sf):
    """Q7: (user, created_at) keys that occur more than once in a batch with late copies."""
    batch = with_late_copies(att(spark, sf).select(*RAW))
    return Q.duplicate_keys(batch, KEYS)


@register("dq_domain", WA + """
select 'attempt_type' column_name,
       count(*) filter (where attempt_type not in ('click', 'view', 'purchase', 'signup'))
         violations from attempts
union all
select 'lesson_id', count(*) filter (where cast(lesson_id as int) not between 0 and 89)
from attempts""")
def dq_domain(spark, sf):
    """Q7: CHECK-style value domains of two columns, in one pass."""
    return Q.domain_violations(att(spark, sf), {
        "attempt_type": ["click", "view", "purchase", "signup"],
        "lesson_id": [str(i) for i in range(90)],
    })


# ------------------------------------------------------------ config runner

#: two weekly runs of these specs: a named aggregate, a user's own SQL with an
#: exclusive period end, and a first-arrival table
WEEKLY_SPECS = [
    {"name": "kinds", "aggregate": "prev_week_by_type", "period": "prev_week",
     "partition_by": ["period_start", "period_end"], "stamps": {"period_end": "period_last"},
     "export": True, "max_null_pct": 0, "critical_columns": ["attempt_type"], "min_rows": 1,
     "columns": ["lti_user_id", "attempt_type", "is_correct", "created_at"]},
    {"name": "lessons", "period": "prev_week", "partition_by": ["period_start", "until"],
     "stamps": {"until": "period_end"}, "export": True, "export_format": "csv", "min_rows": 1,
     "columns": ["lesson_id", "created_at"],
     "sql": """select lesson_id, count(*) n, :period_start period_start, :period_end until
               from {attempts} where created_at >= :period_start and created_at < :period_end
               group by lesson_id"""},
    {"name": "first_seen", "period": "prev_week", "write_mode": "insert_ignore",
     "keys": ["lti_user_id"], "order_by": ["created_at", "event_id"],
     "columns": ["lti_user_id", "attempt_type", "created_at", "event_id"],
     "sql": """select lti_user_id, attempt_type, created_at, event_id from {attempts}
               where created_at >= :period_start and created_at < :period_end"""},
]
RUNS = (DS_NEXT_WEEK, str(plus(DS_NEXT_WEEK, 7)))       # weeks of 01-08 and 01-15
_BOTH = rng("2024-01-08", "2024-01-22")


def _run_weekly(spark, sf):
    """The specs run for two weeks, the second run re-done; results of the last run."""
    base = scratch_path(spark, "config")
    for ds in (*RUNS, RUNS[1]):
        res = S.run_aggregates(spark, S.load_specs(WEEKLY_SPECS), ds, {"attempts": att(spark, sf)},
                               base + "/tables", export_base=base + f"/exports-{ds}",
                               ts_cols={"attempts": "created_at"})
    return res


@register("run_config_union", WA + f"""
select 'kinds' spec_name, count(*) row_count from
  (select attempt_type, date_trunc('week', created_at) from attempts where {_BOTH} group by 1, 2)
union all
select 'lessons', count(*) from
  (select lesson_id, date_trunc('week', created_at) from attempts where {_BOTH} group by 1, 2)
union all
select 'first_seen', count(distinct lti_user_id) from attempts where {_BOTH}""")
def run_config_union(spark, sf):
    """Three declared aggregates over one shared, period-cut scan, two weekly runs."""
    return S.run_summary(spark, _run_weekly(spark, sf))


_LESSONS = f"""select lesson_id, count(*) n, cast(date_trunc('week', created_at) as date) period_start,
       cast(date_trunc('week', created_at) as date) + 7 until from attempts where {{where}} group by 1, 3"""


@register("run_config_rows", WA + _LESSONS.format(where=_BOTH))
def run_config_rows(spark, sf):
    """The rows of a spec's table after two weekly runs."""
    return W.read_table(spark, _run_weekly(spark, sf)[1].path).select("lesson_id", "n", "period_start", "until")


@register("run_config_kinds", WA + f"""
select attempt_type, count(*) total_attempts, count(case when is_correct then 1 end) correct_attempts,
       count(case when not is_correct then 1 end) incorrect_attempts, count(distinct lti_user_id) unique_users,
       {R('count(case when is_correct then 1 end)', 'count(*)')} avg_correct_rate,
       min(created_at) min_created_at, max(created_at) max_created_at,
       cast(date_trunc('week', created_at) as date) period_start,
       cast(date_trunc('week', created_at) as date) + 6 period_end
from attempts where {_BOTH} group by 1, 9""")
def run_config_kinds(spark, sf):
    """C1 with a named aggregate: every value its table holds after two runs."""
    return W.read_table(spark, _run_weekly(spark, sf)[0].path).select(
        "attempt_type", "total_attempts", "correct_attempts", "incorrect_attempts", "unique_users",
        "avg_correct_rate", "min_created_at", "max_created_at", "period_start", "period_end")


@register("run_config_first_seen", WA + f"""
select lti_user_id, attempt_type, created_at, event_id from (
  select *, row_number() over (partition by lti_user_id order by created_at, event_id) r
  from attempts where {_BOTH}) where r = 1""")
def run_config_first_seen(spark, sf):
    """C4 insert-ignore: the first arrival of each user over both runs."""
    return W.read_table(spark, _run_weekly(spark, sf)[2].path)


@register("run_config_export", WA + _LESSONS.format(where=rng("2024-01-15", "2024-01-22")))
def run_config_export(spark, sf):
    """The second run's export holds its own week only."""
    res = _run_weekly(spark, sf)[1]
    return X.read_delimited(spark, res.exported, W.read_table(spark, res.path).select(
        "lesson_id", "n", "period_start", "until").schema, sep=",", header=True)


@register("run_config_empty_source", WA + f"""
select 'skip' policy, 'skipped' outcome union all select 'fail', 'failed' union all
select 'rows', cast(count(distinct attempt_type) as varchar) from attempts where {rng('2024-01-08', '2024-01-15')}""")
def run_config_empty_source(spark, sf):
    """Q8 / Q9: a period without source rows is skipped or fails; one with rows runs."""
    a, out = att(spark, sf), []
    for policy, ds in (("skip", "2031-01-08"), ("fail", "2031-01-08"), ("rows", DS_NEXT_WEEK)):
        spec = S.load_specs([{**WEEKLY_SPECS[0], "export": False,
                              "on_empty_source": "fail" if policy == "rows" else policy}])
        try:
            res = S.run_aggregates(spark, spec, ds, {"attempts": a}, scratch_path(spark, "gate"), None,
                                   {"attempts": "created_at"})[0]
            out.append((policy, "skipped" if not res.path else str(W.read_table(spark, res.path).count())))
        except Q.QualityError:
            out.append((policy, "failed"))
    return spark.createDataFrame(out, "policy string, outcome string")


#: three groupings of one week, computed together
GROUPED_SPECS = [
    {"name": "kinds", "group_by": ["attempt_type"], "partition_by": ["week_start"], "min_rows": 1,
     "max_null_pct": 0, "critical_columns": ["attempt_type"],
     "measures": {"n": "count(*)", "users": "count(distinct lti_user_id)"}},
    {"name": "days", "group_by": ["cast(created_at as date) as day", "attempt_type"], "partition_by": ["week_start"],
     "measures": {"n": "count(*)", "first_id": "min(event_id)"}},
    {"name": "all", "partition_by": ["week_start"], "measures": {"n": "count(*)", "users": "count(distinct lti_user_id)"}},
]


@register("run_config_fused", WA + f""",
w as (select *, cast(date_trunc('week', created_at) as date) week_start from attempts where {_BOTH})
select 'kinds' spec, week_start, attempt_type, cast(null as date) "day", count(*) n,
       count(distinct lti_user_id) users, cast(null as bigint) first_id from w group by 2, 3
union all
select 'days', week_start, attempt_type, cast(created_at as date), count(*), null, min(event_id) from w group by 2, 3, 4
union all
select 'all', week_start, null, null, count(*), count(distinct lti_user_id), null from w group by 2""")
def run_config_fused(spark, sf):
    """Three groupings of a week by GROUPING SETS, two weeks, the second run twice."""
    base = scratch_path(spark, "fused")
    specs = S.load_specs([{**sp, "period": "prev_week", "columns": ["lti_user_id", "attempt_type", "created_at", "event_id"]}
                          for sp in GROUPED_SPECS])
    for ds in (*RUNS, RUNS[1]):
        res = S.run_aggregates(spark, specs, ds, {"attempts": att(spark, sf)}, base, None, {"attempts": "created_at"})
    out = None
    for r in res:
        rows = W.read_table(spark, r.path).withColumn("spec", F.lit(r.spec.name))
        for c, kind in (("attempt_type", "string"), ("day", "date"), ("users", "long"), ("first_id", "long")):
            if c not in rows.columns:
                rows = rows.withColumn(c, F.lit(None).cast(kind))
        rows = rows.select("spec", "week_start", "attempt_type", "day", "n", "users", "first_id")
        out = rows if out is None else out.unionByName(rows)
    return out


#: the running total of a spec that reads its own table, as it was before the run
TOTAL_SPEC = {
    "name": "running_total", "period": "prev_week", "partition_by": ["week_start"],
    "schema": "attempts bigint, total bigint, week_start date",
    "sql": """select a.n attempts, a.n + coalesce(b.total, 0) total, :period_start week_start
              from (select count(*) n from {attempts}
                    where created_at >= :period_start and created_at < :period_end) a
              left join (select max(total) total from IDENTIFIER(:table_name) where week_start < :period_start) b on true"""}


@register("run_config_own_table", WA + f"""
select count(*) attempts, cast(sum(count(*)) over (order by cast(date_trunc('week', created_at) as date)) as bigint) total,
       cast(date_trunc('week', created_at) as date) week_start
from attempts where {_BOTH} group by 3""")
def run_config_own_table(spark, sf):
    """A spec names its own table by IDENTIFIER(:table_name) and adds to what earlier weeks left; re-runs agree."""
    base = scratch_path(spark, "own_table")
    for ds in (*RUNS, RUNS[1]):
        res = S.run_aggregates(spark, S.load_specs([TOTAL_SPEC]), ds, {"attempts": att(spark, sf)}, base, None,
                               {"attempts": "created_at"})
    return W.read_table(spark, res[0].path)


@register("run_config_all_or_nothing", WA + f"""
select 'kinds' spec_name, count(distinct attempt_type) row_count, false export_written from attempts
where {rng('2024-01-08', '2024-01-15')}
union all select 'lessons', count(distinct lesson_id), false from attempts where {rng('2024-01-08', '2024-01-15')}""")
def run_config_all_or_nothing(spark, sf):
    """In the second week the second of two specs fails its check; both
    tables stay as the first week left them and nothing is exported."""
    base, out = scratch_path(spark, "atomic"), []
    specs = [{**sp, "min_rows": 1} for sp in WEEKLY_SPECS[:2]]
    a = att(spark, sf)
    res = S.run_aggregates(spark, S.load_specs(specs), RUNS[0], {"attempts": a}, base + "/tables", None,
                           {"attempts": "created_at"})
    try:
        S.run_aggregates(spark, S.load_specs([specs[0], {**specs[1], "min_rows": 1_000_000_000}]), RUNS[1],
                         {"attempts": a}, base + "/tables", base + "/exports", {"attempts": "created_at"})
    except Q.QualityError:
        fs, folder = W._fs(spark, base + "/exports")
        for r in res:
            out.append((r.spec.name, W.read_table(spark, r.path).count(), bool(fs.exists(folder))))
    return spark.createDataFrame(out, "spec_name string, row_count long, export_written boolean")
