"""Registered streaming queries (ST1–ST3); each runs the stream to
completion (availableNow) and returns what the sink holds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import writes as W
from ..session import scratch_path
from ..sources import tables as T
from ..streaming import jobs as S
from .registry import ATTEMPTS, register, with_

RAW = ["event_id", "lti_user_id", "attempt_type", "created_at", "is_correct"]
KEYS = ["lti_user_id", "created_at"]
WA = with_(ATTEMPTS)


@register("stream_dedup", WA + "select event_id, lti_user_id, attempt_type, created_at, "
          "is_correct from attempts")
def stream_dedup(spark, sf):
    """ST1: two incremental runs of one ingest stream (same checkpoint).  All
    attempts arrive first; later copies of every 'click' row (same key, later
    id, other payload) arrive for the second run and are dropped: the first
    arrival wins.  The table is partitioned by the key's day, so each batch
    reads its own days only."""
    landing = scratch_path(spark, "landing")
    a = T.attempts(spark, sf).select(*RAW)
    copies = (a.filter(F.col("attempt_type") == "click")
              .withColumn("event_id", F.col("event_id") + F.lit(1_000_000_000))
              .withColumn("attempt_type", F.lit("click_copy")))
    table, ck = scratch_path(spark, "dedup_tbl"), scratch_path(spark, "dedup_ck")
    for arrival in (a, copies):
        arrival.write.mode("append").parquet(landing)
        src = S.file_stream(spark, landing, a.schema).withColumn("day", F.col("created_at").cast("date"))
        S.run_inserting(spark, src, table, ck, KEYS, ["event_id"], ["day"], partitions_follow_key=True)
    return W.read_table(spark, table).select(*RAW)


@register("stream_dedup_state", WA + "select event_id, lti_user_id, attempt_type, created_at, "
          "is_correct from attempts")
def stream_dedup_state(spark, sf):
    """ST1 with state, three runs from one checkpoint: rows from 01-12 on with
    all but the views; then the views, of which those older than the two days'
    delay are beyond the watermark, and copies of the clicks of the last days,
    inside it; then all rows before 01-12, far beyond it, with copies of all
    clicks.  No row is lost and no copy kept."""
    landing = scratch_path(spark, "landing_state")
    a = T.attempts(spark, sf).select(*RAW)
    cut = F.lit("2024-01-12").cast("timestamp_ntz")
    copies = (a.filter(F.col("attempt_type") == "click")
              .withColumn("event_id", F.col("event_id") + F.lit(1_000_000_000))
              .withColumn("attempt_type", F.lit("click_copy")))
    late, views = a.filter(F.col("created_at") < cut), F.col("attempt_type") == "view"
    last = a.agg(F.max("created_at")).first()[0]
    out, ck = scratch_path(spark, "state_tbl"), scratch_path(spark, "state_ck")
    for arrival in (a.filter((F.col("created_at") >= cut) & ~views),
                    a.filter((F.col("created_at") >= cut) & views).unionByName(
                        copies.filter(F.col("created_at") > F.lit(last) - F.expr("interval 1 day"))),
                    late.unionByName(copies)):
        arrival.write.mode("append").parquet(landing)
        S.run_deduplicated(spark, S.file_stream(spark, landing, a.schema), out, ck, KEYS, ["event_id"], "2 days")
    return S.deduplicated(spark, out).select(*RAW)


@register("stream_day_week", WA + """
select level, date_trunc(level, created_at)::timestamp "start", lti_user_id, attempt_type,
       count(*) attempt_count, count(case when is_correct then null else 1 end) attempt_failed_count
from attempts, (values ('day'), ('week')) l(level)
where date_trunc('week', created_at) + interval 7 day <= (select max(ts) - interval 1 day from events)
group by 1, 2, 3, 4""")
def stream_day_week(spark, sf):
    """ST2: days and Monday weeks of one stream, by chained windows over one scan."""
    ev = spark.read.parquet(T.table_path(sf, "events"))
    src = S.file_stream(spark, sf, ev.schema, glob="events.parquet")
    out, ck = scratch_path(spark, "day_week_out"), scratch_path(spark, "day_week_ck")
    S.run_day_week(spark, T.attempts_from_events(src), out, ck, "1 day")
    return S.by_level(spark.read.parquet(out))


WEEKLY_SQL = WA + """
select cast(date_trunc('week', created_at) as timestamp) week_start, lti_user_id, attempt_type,
       count(*) attempt_count, count(case when is_correct then null else 1 end) attempt_failed_count
from attempts {where} group by 1, 2, 3"""


@register("stream_weekly", WEEKLY_SQL.format(
    where="where date_trunc('week', created_at) + interval 7 day <= "
          "(select max(ts) - interval 1 day from events)"))
def stream_weekly(spark, sf):
    """ST2: Monday weeks over the events stream; append mode holds back the
    week the watermark (max time − 1 day) has not passed."""
    ev = spark.read.parquet(T.table_path(sf, "events"))
    src = S.file_stream(spark, sf, ev.schema, glob="events.parquet")
    out, ck = scratch_path(spark, "weekly_out"), scratch_path(spark, "weekly_ck")
    S.run_to_parquet(S.weekly_stream(T.attempts_from_events(src), "1 day"), out, ck)
    return spark.read.parquet(out)


@register("stream_upsert_weekly", WEEKLY_SQL.format(where=""))
def stream_upsert_weekly(spark, sf):
    """ST3: the same weeks in update mode, upserted per micro-batch, over two
    incremental runs: events before 2024-01-20 arrive first, the rest later,
    so the week of 01-15 is written by the first run and updated by the second."""
    landing = scratch_path(spark, "landing_w")
    ev = T.read_table(spark, sf, "events")
    cut = F.lit("2024-01-20").cast("timestamp_ntz")
    table, ck = scratch_path(spark, "weekly_tbl"), scratch_path(spark, "weekly_ck2")
    for arrival in (ev.filter(F.col("ts") < cut), ev.filter(F.col("ts") >= cut)):
        arrival.write.mode("append").parquet(landing)
        src = S.file_stream(spark, landing, ev.schema)
        # rows up to two weeks late still update their week
        S.run_upserting(spark, S.weekly_stream(T.attempts_from_events(src), "14 days"), table,
                        ck, ["week_start", "lti_user_id", "attempt_type"], ["week_start"])
    return W.read_table(spark, table).select("week_start", "lti_user_id", "attempt_type",
                                            "attempt_count", "attempt_failed_count")
