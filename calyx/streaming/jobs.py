"""Structured Streaming jobs ST1–ST3.

* ST1 — incremental ingest where the first record per (user, created_at)
  wins: each micro-batch is inserted with W5 (``foreachBatch``), so a new key
  is kept however late it comes, and there is no state to outgrow a watermark.
  Only the table's rows in the batch's own time range are read.  With a delay
  given (``run_deduplicated``) copies are told by RocksDB state instead, for as
  long as the watermark allows, and only rows beyond it go through W5.
* ST2 — tumbling Monday-aligned weeks (the batch A2 weeks): a 7-day window
  with a 4-day start offset (1970-01-01 was a Thursday).  Append mode emits
  a week once the watermark passes its end; the open week stays in state.
  Days and weeks come from one stream by chained windows: weeks are grouped
  from the day windows, by ``window_time``.
* ST3 — per-micro-batch upsert of the running aggregates (``foreachBatch``
  → W4), so the table always holds the latest value of every open window.

Event time must be a zoned TIMESTAMP for watermarks; the NTZ column is cast
under the session's UTC zone, which keeps the wall-clock value, and cast
back on output.  Runs use ``trigger(availableNow=True)`` and a checkpoint in
the shared work folder, so a restarted job resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import correctness as ok
from ..operators import writes as W

WEEK = ("7 days", "7 days", "4 days")  # window, slide, start offset → Monday weeks
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def file_stream(spark: SparkSession, path: str, schema, glob: str | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.parquet(path)


def with_event_time(df: DataFrame, col: str = "created_at", out: str = "_event_time") -> DataFrame:
    return df.withColumn(out, F.col(col).cast("timestamp"))


def weekly_stream(df: DataFrame, delay: str, col: str = "created_at") -> DataFrame:
    """ST2 — A1 per Monday week × user × type as a windowed streaming aggregate."""
    g = (with_event_time(df, col).withWatermark("_event_time", delay)
         .groupBy(F.window("_event_time", *WEEK).alias("w"), "lti_user_id", "attempt_type")
         .agg(F.count(F.lit(1)).alias("attempt_count"),
              ok.failed_null_counts("is_correct").alias("attempt_failed_count")))
    return g.select(F.col("w.start").cast("timestamp_ntz").alias("week_start"), "lti_user_id",
                    "attempt_type", "attempt_count", "attempt_failed_count")


def day_week_stream(df: DataFrame, delay: str, col: str = "created_at") -> DataFrame:
    """ST2 — A1 per day and per Monday week × user × type, by chained windows of one stream.

    A row is a week with the rows of its days (at most seven) beside it; a day
    is closed by the watermark, and its week when the last day's window_time is.
    """
    days = (with_event_time(df, col).withWatermark("_event_time", delay)
            .groupBy(F.window("_event_time", "1 day").alias("d"), "lti_user_id", "attempt_type")
            .agg(F.count(F.lit(1)).alias("attempt_count"),
                 ok.failed_null_counts("is_correct").alias("attempt_failed_count")))
    start = F.col("d.start").cast("timestamp_ntz").alias("start")
    weeks = (days.withColumn("day", F.struct(start, "attempt_count", "attempt_failed_count"))
             .groupBy(F.window(F.window_time("d"), *WEEK).alias("w"), "lti_user_id", "attempt_type")
             .agg(F.sum("attempt_count").alias("attempt_count"),
                  F.sum("attempt_failed_count").alias("attempt_failed_count"), F.collect_list("day").alias("days")))
    return weeks.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "lti_user_id", "attempt_type",
                        "attempt_count", "attempt_failed_count", "days")


def by_level(rows: DataFrame) -> DataFrame:
    """The rows of ``day_week_stream`` as (level, start, ...): the week's and each of its days'."""
    week = F.struct(F.lit("week").alias("level"), "start", "attempt_count", "attempt_failed_count")
    day = F.transform("days", lambda d: F.struct(F.lit("day").alias("level"), d["start"].alias("start"),
                                                 d["attempt_count"].alias("attempt_count"),
                                                 d["attempt_failed_count"].alias("attempt_failed_count")))
    return rows.select("lti_user_id", "attempt_type", F.explode(F.concat(F.array(week), day)).alias("x")) \
        .select("x.level", "x.start", "lti_user_id", "attempt_type", "x.attempt_count", "x.attempt_failed_count")


class _conf:
    """Temporarily set a SQL conf while a stream starts.

    The number of state-store partitions is read from
    ``spark.sql.shuffle.partitions`` when a query first starts and is then
    fixed in its checkpoint; sizing it to the cluster's parallelism (instead
    of whatever the session holds) keeps every micro-batch one wave wide.
    """

    def __init__(self, spark, key, value):
        self.spark, self.key, self.value = spark, key, value

    def __enter__(self):
        self.old = self.spark.conf.get(self.key, None)
        if self.value is not None:
            self.spark.conf.set(self.key, str(self.value))

    def __exit__(self, *exc):
        if self.value is not None and self.old is not None:
            self.spark.conf.set(self.key, self.old)
        elif self.value is not None:
            self.spark.conf.unset(self.key)


def state_partitions(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def run_to_parquet(stream: DataFrame, out: str, checkpoint: str, mode: str = "append",
                   partitions: int | None = None) -> None:
    """Process everything available, then stop (restartable via the checkpoint).

    ``partitions``: state partitions, fixed when the query first starts; size
    them for the cluster the stream will grow to (default: that of today).
    """
    spark = stream.sparkSession
    with _conf(spark, "spark.sql.shuffle.partitions", partitions or state_partitions(spark)):
        q = (stream.writeStream.outputMode(mode).format("parquet")
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out))
    q.awaitTermination()


def _run_batches(spark: SparkSession, stream: DataFrame, mode: str, write, checkpoint: str,
                 partitions: int | None) -> None:
    with _conf(spark, "spark.sql.shuffle.partitions", partitions or state_partitions(spark)):
        q = (stream.writeStream.outputMode(mode).foreachBatch(lambda batch, _: write(batch))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def run_inserting(spark: SparkSession, stream: DataFrame, table: str, checkpoint: str, keys, order_by,
                  partition_by=None, partitions: int | None = None, partitions_follow_key: bool = False) -> None:
    """ST1 — insert-ignore (W5) per micro-batch.

    A batch that foreachBatch replays after a failure finds its keys in the
    table and adds nothing. The table is read in the batch's time range only
    and, if equal keys lie in equal partitions (``partitions_follow_key``), in
    the batch's partitions only.
    """
    _run_batches(spark, stream, "append",
                 lambda batch: W.insert_ignore(batch.sparkSession, batch, table, keys, order_by, partition_by,
                                               partitions_follow_key=partitions_follow_key),
                 checkpoint, partitions)


def deduplicated(spark: SparkSession, out: str) -> DataFrame:
    """What ``run_deduplicated`` has kept: rows in time and late ones."""
    rows = spark.read.parquet(f"{out}/in_time")
    if W.table_exists(spark, f"{out}/late"):
        rows = rows.unionByName(W.read_table(spark, f"{out}/late"))
    return rows


def run_deduplicated(spark: SparkSession, stream: DataFrame, out: str, checkpoint: str, keys, order_by, delay: str,
                     time_col: str = "created_at", partitions: int | None = None) -> None:
    """ST1 with state — one row per key; ``time_col`` is one of the keys.

    Rows in time go through ``dropDuplicatesWithinWatermark`` with RocksDB
    state, to Spark's exactly-once file sink: no table is read for them. Spark
    drops rows beyond the watermark; a second query over the same source takes
    the rows up to the watermark that the first one reached and inserts with
    W5 those whose key is kept nowhere yet. Its rows are a superset of what the
    first one dropped, so none is lost, and one that was kept is found and left
    out. Of copies in one micro-batch of the first query any one stays.
    """
    if time_col not in keys:
        raise ValueError(f"{time_col} must be a key: a copy could come in another window")
    columns = stream.columns
    timed = with_event_time(stream, time_col)
    first = timed.withWatermark("_event_time", delay).dropDuplicatesWithinWatermark(list(keys)).select(*columns)
    with _conf(spark, "spark.sql.shuffle.partitions", partitions or state_partitions(spark)), \
            _conf(spark, "spark.sql.streaming.stateStore.providerClass", ROCKSDB):
        q = (first.writeStream.outputMode("append").format("parquet")
             .option("checkpointLocation", f"{checkpoint}/in_time").trigger(availableNow=True).start(f"{out}/in_time"))
    q.awaitTermination()
    reached = (q.lastProgress or {}).get("eventTime", {}).get("watermark")
    # without a watermark to go by, all that the second query has not seen yet is looked up
    late = timed.filter(F.col("_event_time") <= F.lit(reached).cast("timestamp")) if reached else timed

    def insert(batch: DataFrame) -> None:
        spark = batch.sparkSession
        with W.new_rows(batch.select(*columns), deduplicated(spark, out), keys, order_by) as rows:
            W.write_append(rows, f"{out}/late")

    _run_batches(spark, late, "append", insert, f"{checkpoint}/late", partitions)


def run_day_week(spark: SparkSession, stream: DataFrame, out: str, checkpoint: str, delay: str,
                 col: str = "created_at", partitions: int | None = None) -> None:
    """ST2 — both levels in one stream and one scan; read with ``by_level``."""
    run_to_parquet(day_week_stream(stream, delay, col), out, checkpoint, partitions=partitions)


def run_upserting(spark: SparkSession, stream: DataFrame, table: str, checkpoint: str, keys,
                  partition_by=None, partitions: int | None = None) -> None:
    """ST3 — update-mode aggregates upserted into ``table`` per micro-batch.

    foreachBatch may replay a batch after a failure; the upsert leaves the
    table as it was if it fails and is idempotent, so a replay gives the same
    table.  With ``partition_by`` among the keys only the partitions a batch
    touches are rewritten.
    """
    _run_batches(spark, stream, "update",
                 lambda batch: W.upsert(batch.sparkSession, batch, table, keys, partition_by),
                 checkpoint, partitions)
