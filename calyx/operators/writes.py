"""Write modes W1–W8 on tables of the session catalogue, written by Spark's own committers.

A table is named by its catalogue name, or by its folder (anything with a
slash). A folder is registered as an external Parquet table on first use, its
partitions recovered, so ``read_table``, SQL by name and partition DDL see the
same table. What a table is (columns, types, partitions, buckets) is what the
catalogue says; with a persistent catalogue it also outlives the application,
else a folder's columns are taken from its files and its batch.

* append (W1) is ``INSERT INTO``;
* period replace (W3) is ``INSERT OVERWRITE`` with dynamic partitions; requested
  periods that came out empty are emptied and dropped with ``ALTER TABLE … DROP
  IF EXISTS PARTITION``, as DELETE + INSERT would leave them;
* range replace (W3b) and upsert (W4) do the same with the rows that stay in
  the partitions they touch;
* full refresh (W2) overwrites all partitions and drops the others; a table
  without partitions is overwritten from a staged copy, as Spark removes its
  files before it writes;
* insert-ignore (W5), insert-if-period-absent (W6), load-if-empty (W7) append;
* create / drop (W8).

A query that fails while it writes leaves the table as it was: Spark's dynamic
overwrite moves files into place when all tasks have succeeded. One writer per
table is assumed. Batches are matched by name with the table's columns;
missing, extra or differently typed columns raise. Which partitions a write
holds is observed while it runs: one value per partition reaches the driver.
"""

from __future__ import annotations

import hashlib
import re
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .joins import dedup_first_wins, null_key, upsert_frames

TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


# ------------------------------------------------------------------ catalogue

def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(value: str | None) -> str:
    return "null" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_name(ref: str) -> str:
    """The catalogue name of a table: ``ref`` itself, or one made from a folder."""
    if "/" not in ref:
        return ref
    path = ref.rstrip("/")
    slug = re.sub(r"\W+", "_", path.rpartition("/")[2]).lower()
    return f"{slug}_{hashlib.md5(path.encode()).hexdigest()[:12]}"


def _create(spark: SparkSession, ref: str, schema: T.StructType | None, partition_by=None, bucket_by=None) -> None:
    """CREATE TABLE; without ``schema`` Spark takes columns and partitions from the files."""
    text = f"CREATE TABLE {table_name(ref)}"
    if schema is not None:
        text += f" ({', '.join(f'{_quoted(f.name)} {f.dataType.simpleString()}' for f in schema.fields)})"
    text += " USING parquet"
    if partition_by:
        text += f" PARTITIONED BY ({', '.join(map(_quoted, partition_by))})"
    if bucket_by:
        n, keys = bucket_by
        cols = ", ".join(map(_quoted, keys))
        text += f" CLUSTERED BY ({cols}) SORTED BY ({cols}) INTO {n} BUCKETS"
    if "/" in ref:
        text += f" LOCATION {_literal(ref.rstrip('/'))}"
    spark.sql(text)


def table_exists(spark: SparkSession, ref: str, like: T.StructType | None = None, partition_by=None) -> bool:
    """J7 — the catalogue knows the table, or its folder holds Parquet data (which is then registered).

    ``like`` and ``partition_by`` give a folder's partition columns the types of
    the batch at hand, where their names in the folder leave them open.
    """
    name = table_name(ref)
    if spark.catalog.tableExists(name):
        return True
    if "/" not in ref:
        return False
    fs, folder = _fs(spark, ref)
    if not fs.exists(folder):
        return False
    try:
        found = spark.read.parquet(ref).schema
    except AnalysisException as e:
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":          # no data files
            return False
        raise
    parts = [c for c in partition_by or [] if like is not None and c in like.names and c in found.names]
    if parts:
        fields = [T.StructField(f.name, like[f.name].dataType) if f.name in parts else f for f in found.fields]
        _create(spark, ref, T.StructType(fields), parts)
    else:
        _create(spark, ref, None)
    if partition_columns(spark, ref):
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return True


def _ensure(spark: SparkSession, ref: str, schema: T.StructType, partition_by=None, bucket_by=None) -> bool:
    """Create the table unless it exists. True if created."""
    if table_exists(spark, ref, schema, partition_by):
        return False
    _create(spark, ref, schema, list(partition_by or []), bucket_by)
    return True


def partition_columns(spark: SparkSession, ref: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table_name(ref)) if c.isPartition]


def read_table(spark: SparkSession, ref: str) -> DataFrame:
    """The table's rows, partition columns last; a table whose partitions were all dropped has none."""
    if not table_exists(spark, ref):
        raise FileNotFoundError(f"no table at {ref}")
    # a stream's batches write in a session of their own, which leaves this one's list of files as it was
    spark.catalog.refreshTable(table_name(ref))
    return spark.table(table_name(ref))


# ------------------------------------------------------------------- writing

def aligned(df: DataFrame, spark: SparkSession, ref: str, partition_by=None) -> DataFrame:
    """``df`` with the table's columns in the table's order.

    Raises when a column is missing, is not the table's, or has another type
    (nullability aside): an append may not hide or reinterpret older rows.
    """
    if not table_exists(spark, ref, df.schema, partition_by):
        return df
    schema = spark.table(table_name(ref)).schema
    want = {f.name: f.dataType.simpleString() for f in schema.fields}
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wrong = {c: (want.get(c), have.get(c)) for c in {**want, **have} if want.get(c) != have.get(c)}
    if wrong:
        raise ValueError(f"{ref}: columns differ from the table's (table, batch): {wrong}")
    return df.select(*[F.col(_quoted(f.name)) for f in schema.fields])


def clustered(df: DataFrame, partition_by) -> DataFrame:
    """Rows of a partition together before a partitioned write, so that a period
    is a few files, not one per task; AQE splits a period that is large."""
    return df.hint("rebalance", *partition_by) if partition_by else df


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def _insert(df: DataFrame, ref: str, overwrite: bool = False) -> set:
    """INSERT INTO / INSERT OVERWRITE with dynamic partitions; the partitions written, as tuples."""
    spark, name = df.sparkSession, table_name(ref)
    columns = spark.catalog.listColumns(name)
    parts, buckets = [c.name for c in columns if c.isPartition], [c.name for c in columns if c.isBucket]
    if buckets:
        count = int(next(r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()
                         if r["col_name"] == "Num Buckets"))
        df = df.repartition(count, *buckets)            # a file for each bucket
    else:
        df = clustered(df, parts)
    seen = Observation()
    if parts:
        df = df.observe(seen, F.collect_set(F.struct(*map(_quoted, parts))).alias("parts"))
    with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        df.write.insertInto(name, overwrite=overwrite)
    return {tuple(r) for r in seen.get["parts"]} if parts else set()


def _partition_values(spark: SparkSession, specs: list[dict], schema: T.StructType, parts) -> dict[tuple, tuple]:
    """Typed values -> the strings that name the partition, for periods given as ``{column: value}``."""
    if not specs:
        return {}
    asked = []
    for spec in specs:
        typed = [F.lit(spec[c]).cast(schema[c].dataType) for c in parts]
        asked.append(F.struct(F.struct(*[v.alias(c) for v, c in zip(typed, parts)]).alias("v"),
                              F.struct(*[v.cast("string").alias(c) for v, c in zip(typed, parts)]).alias("s")))
    row = spark.range(1).select(F.array(*asked)).first()[0]                 # an entry for each period asked for
    return {tuple(x["v"]): tuple(x["s"]) for x in row}


def drop_partitions(spark: SparkSession, ref: str, values: list[tuple]) -> None:
    """Empties the partitions (strings as in their names) through the writer, then drops them from the catalogue.

    DROP PARTITION alone leaves an external table's files behind.
    """
    name, parts = table_name(ref), partition_columns(spark, ref)
    schema = spark.table(name).schema
    nothing = ", ".join(f"cast(null as {f.dataType.simpleString()})" for f in schema.fields if f.name not in parts)
    for value in values:
        spec = ", ".join(f"{_quoted(c)} = {_literal(v)}" for c, v in zip(parts, value))
        if not spark.sql(f"SHOW PARTITIONS {name} PARTITION ({spec})").isEmpty():
            spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({spec}) SELECT {nothing} WHERE false")
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")


def _in_partitions(parts, values) -> Column:
    """Rows of the given partitions (typed tuples), as a predicate that prunes the scan."""
    cond = F.lit(False)
    for value in values:
        one = F.lit(True)
        for c, v in zip(parts, value):
            one = one & (F.col(_quoted(c)).isNull() if v is None else F.col(_quoted(c)) == F.lit(v))
        cond = cond | one
    return cond


def _distinct(df: DataFrame, parts) -> set:
    return {tuple(r) for r in df.select(*map(_quoted, parts)).distinct().collect()}     # a row per partition


def _replace(spark: SparkSession, df: DataFrame, ref: str, touched: set) -> None:
    """Overwrite the partitions of ``df``; those of ``touched`` that it doesn't hold are dropped."""
    parts = partition_columns(spark, ref)
    gone = touched - _insert(df, ref, overwrite=True)
    if gone:
        specs = [dict(zip(parts, value)) for value in gone]
        schema = spark.table(table_name(ref)).schema
        drop_partitions(spark, ref, list(_partition_values(spark, specs, schema, parts).values()))


class Staged:
    """``df`` written once to the work folder, for inputs that several steps read;
    the folder goes at the end of the ``with`` block.

    ``observe`` (aggregates by alias) are computed while it is written and
    found in ``seen``.
    """

    def __init__(self, df: DataFrame, name: str = "stage", partition_by=None, observe=()):
        self.df, self.partition_by, self.observe = df, list(partition_by or []), list(observe)
        self.path, self.seen = scratch_path(df.sparkSession, name), {}

    def __enter__(self) -> DataFrame:
        df, seen = clustered(self.df, self.partition_by), Observation()
        if self.observe:
            df = df.observe(seen, *self.observe)
        w = df.write.mode("errorifexists")
        (w.partitionBy(*self.partition_by) if self.partition_by else w).parquet(self.path)
        if self.observe:
            self.seen = seen.get
        return self.df.sparkSession.read.schema(self.df.schema).parquet(self.path).select(
            *[_quoted(c) for c in self.df.columns])

    def __exit__(self, *exc):
        delete_path(self.df.sparkSession, self.path)


# ------------------------------------------------------------------- W1, W2, W8

def write_append(df: DataFrame, ref: str, partition_by=None, bucket_by=None) -> None:
    """W1 — append; a re-run appends the rows again.

    ``bucket_by`` = (number, keys) is used when the table is created: its rows
    are clustered by the keys, so a join on them doesn't shuffle the table.
    """
    spark = df.sparkSession
    df = aligned(df, spark, ref, partition_by)
    created = _ensure(spark, ref, df.schema, partition_by, bucket_by)
    try:
        _insert(aligned(df, spark, ref), ref)
    except BaseException:
        if created:
            drop_table(spark, ref)
        raise


def write_full_refresh(df: DataFrame, ref: str, partition_by=None) -> None:
    """W2 — TRUNCATE + INSERT: the whole table is replaced, once all new rows are written.

    The table may get other columns; ``df`` may read the table it replaces.
    With the same partition columns as before the rows are written once, by a
    dynamic overwrite; otherwise they are staged first.
    """
    spark, partition_by = df.sparkSession, list(partition_by or [])
    if not table_exists(spark, ref, df.schema, partition_by):
        write_append(df, ref, partition_by)
        return
    kinds = lambda s: {f.name: f.dataType.simpleString() for f in s.fields}
    same = kinds(spark.table(table_name(ref)).schema) == kinds(df.schema) and \
        partition_columns(spark, ref) == partition_by
    if same and partition_by:
        _replace(spark, aligned(df, spark, ref), ref, _distinct(read_table(spark, ref), partition_by))
        return
    with Staged(df, "refresh") as rows:
        if not same:
            drop_table(spark, ref)
            write_append(rows, ref, partition_by)
        else:
            _insert(aligned(rows, spark, ref), ref, overwrite=True)


def create_if_missing(spark: SparkSession, ref: str, schema: T.StructType, partition_by=None, bucket_by=None) -> bool:
    """W8 — CREATE TABLE IF NOT EXISTS. True if created."""
    return _ensure(spark, ref, schema, partition_by, bucket_by)


def drop_table(spark: SparkSession, ref: str) -> bool:
    """W8 — DROP TABLE IF EXISTS, with the rows. True if there was one."""
    found = table_exists(spark, ref)
    spark.sql(f"DROP TABLE IF EXISTS {table_name(ref)}")
    if "/" in ref:
        delete_path(spark, ref)
    return found


# ------------------------------------------------------------------------- W3

def replace_periods(spark: SparkSession, df: DataFrame, ref: str, partition_by,
                    periods=None, source_reads_target: bool = True) -> None:
    """W3 — DELETE the periods, then INSERT ``df``.

    ``partition_by`` are the period stamp columns.  ``periods`` lists the
    periods being replaced as dicts ``{col: value}``; any of them absent from
    ``df`` is dropped from the table, so an empty re-run empties the period
    like DELETE + INSERT would.  Without ``periods`` only periods present in
    ``df`` are replaced.  Values are compared in the column's type: a DATE
    given for a TIMESTAMP stamp means its midnight.

    ``df`` is computed once and may read the table, as nothing is removed
    before it is written (so ``source_reads_target`` makes no difference).
    """
    partition_by = list(partition_by)
    _ensure(spark, ref, df.schema, partition_by)
    df = aligned(df, spark, ref)
    parts = partition_columns(spark, ref)
    asked = set(_partition_values(spark, list(periods or []), df.schema, parts))
    _replace(spark, df, ref, asked)


def replace_periods_ignoring(spark: SparkSession, df: DataFrame, ref: str, partition_by, periods,
                             keys, order_by) -> None:
    """W3 + W5 — DELETE the periods, then INSERT ... ON CONFLICT DO NOTHING.

    Of rows with one key the first by ``order_by`` wins, and a key that the
    table holds in a period that stays is not inserted again.
    """
    rows = dedup_first_wins(df, keys, order_by)
    if table_exists(spark, ref, df.schema, partition_by):
        table = read_table(spark, ref)
        going = _in_partitions(partition_by, _partition_values(spark, periods, table.schema, partition_by))
        rows = rows.join(table.filter(~F.coalesce(going, F.lit(False))).select(*keys), list(keys), "left_anti")
    replace_periods(spark, rows.select(*df.columns), ref, partition_by, periods)


def in_time_range(table: DataFrame, time_col: str, start, end) -> Column:
    """``start`` <= ``time_col`` < ``end`` in the column's type, as a predicate that reaches the scan."""
    kind = table.schema[time_col].dataType
    return (F.col(time_col) >= F.lit(start).cast(kind)) & (F.col(time_col) < F.lit(end).cast(kind))


def write_range_replace(spark: SparkSession, df: DataFrame, ref: str, time_col: str, start, end,
                        partition_by=None) -> None:
    """W3b — DELETE rows with ``start`` <= ``time_col`` < ``end``, then INSERT ``df``.

    The range may cut through partitions. Only partitions that hold rows of the
    range (found by a scan with the range pushed down) or of ``df`` are read
    and rewritten: their rows outside the range, also those without a time,
    plus ``df``. A partition with nothing left is dropped. Rows of ``df``
    outside the range raise, as a re-run would not remove them.
    """
    partition_by = list(partition_by or [])
    _ensure(spark, ref, df.schema, partition_by)
    df = aligned(df, spark, ref)
    table, parts = read_table(spark, ref), partition_columns(spark, ref)
    inside = in_time_range(table, time_col, start, end)
    outside = F.count_if(~F.coalesce(inside, F.lit(False))).alias("outside")
    holds = [F.collect_set(F.struct(*map(_quoted, parts))).alias("parts")] if parts else []
    stage = Staged(df, "range", observe=[outside, *holds])
    with stage as rows:
        if stage.seen["outside"]:
            raise ValueError(f"{ref}: {stage.seen['outside']} rows outside {start} .. {end}")
        kept = table.filter(~F.coalesce(inside, F.lit(False)))
        if not parts:
            with Staged(kept.unionByName(rows), "range_rows") as merged:
                _insert(aligned(merged, spark, ref), ref, overwrite=True)
            return
        touched = _distinct(table.filter(inside), parts) | {tuple(r) for r in stage.seen["parts"]}
        kept = kept.filter(_in_partitions(parts, touched))
        _replace(spark, aligned(kept.unionByName(rows), spark, ref), ref, touched)


# ------------------------------------------------------------------------- W4

def upsert(spark: SparkSession, source: DataFrame, ref: str, keys, partition_by=None) -> None:
    """W4 / J5 — insert or update by ``keys``.

    Two source rows with one key raise, as ON CONFLICT DO UPDATE does (rows
    with a NULL key never conflict).  Only the partitions that the source
    touches are read whole and rewritten.  When the partition columns belong
    to the key these are the source's own; otherwise a key may move, and those
    that hold one of the source's keys are found first by a semi join of key
    and partition columns. A table without partitions is merged whole.
    """
    keys = list(keys)
    source = aligned(source, spark, ref, partition_by)
    exists = table_exists(spark, ref)
    parts = partition_columns(spark, ref) if exists else list(partition_by or [])
    holds = [F.collect_set(F.struct(*map(_quoted, parts))).alias("parts")] if parts else []
    stage = Staged(source, "upsert", observe=holds)
    with stage as src:
        twice = src.filter(~null_key(keys)).groupBy(*keys).count().filter("count > 1").limit(1).collect()
        if twice:
            raise ValueError(f"{ref}: two source rows for one key, {twice[0].asDict()}")
        if not exists:
            write_append(src, ref, parts)
            return
        target = read_table(spark, ref)
        if not parts:
            with Staged(upsert_frames(target, src, keys), "upsert_rows") as merged:
                _insert(aligned(merged, spark, ref), ref, overwrite=True)
            return
        touched = {tuple(r) for r in stage.seen["parts"]}
        if not set(parts) <= set(keys):
            held = target.select(*dict.fromkeys([*keys, *parts])).join(src.select(*keys), keys, "left_semi")
            touched |= _distinct(held, parts)
        merged = upsert_frames(target.filter(_in_partitions(parts, touched)), src, keys)
        _replace(spark, aligned(merged, spark, ref), ref, touched)


# ---------------------------------------------------------------- W5, W6, W7

def range_metrics(schema: T.StructType, keys) -> list[Column]:
    """Least and largest of each time key, to be observed while rows are staged."""
    times = [k for k in keys if isinstance(schema[k].dataType, TIMES)]
    return [x for k in times for x in (F.min(k).alias(f"{k}__least"), F.max(k).alias(f"{k}__most"))]


def in_observed_range(target: DataFrame, keys, seen: dict) -> DataFrame:
    """The rows of ``target`` whose time keys lie in the observed ranges; without times seen, none do."""
    for k in keys:
        if f"{k}__least" in seen:
            least, most = seen[f"{k}__least"], seen[f"{k}__most"]
            target = target.filter(F.lit(False) if least is None else F.col(k).between(F.lit(least), F.lit(most)))
    return target


def new_rows(batch: DataFrame, target: DataFrame, keys, order_by, derived_partitions=()) -> Staged:
    """J3 — rows of ``batch`` whose key is not in ``target`` (in-batch first wins), the target read only where needed.

    Spark prunes no scan at run time for an anti join. The batch's first rows
    are staged, which they must be anyway before they are appended to the table
    they are compared with; the range of each time key is observed on the way
    and pushed to the target's scan. ``derived_partitions`` are columns of both
    sides that follow from the key (the day of its time): then only the
    batch's partitions are read. Rows with a NULL key are always new.

    Use as ``with new_rows(...) as rows``.
    """
    keys = list(keys)
    first = dedup_first_wins(batch, keys, order_by)
    observe = range_metrics(batch.schema, keys)
    if derived_partitions:
        observe.append(F.collect_set(F.struct(*map(_quoted, derived_partitions))).alias("parts"))

    class New(Staged):
        def __enter__(self) -> DataFrame:
            rows = super().__enter__()
            known = in_observed_range(target, keys, self.seen)
            if derived_partitions:
                known = known.filter(_in_partitions(derived_partitions, [tuple(r) for r in self.seen["parts"]]))
            return rows.join(known.select(*keys), keys, "left_anti").select(*rows.columns)

    return New(first, "first_rows", observe=observe)


def insert_ignore(spark: SparkSession, batch: DataFrame, ref: str, keys, order_by,
                  partition_by=None, within=None, partitions_follow_key: bool = False) -> None:
    """W5 / J4 — ``ON CONFLICT DO NOTHING``: first row per key wins, existing keys are kept.

    Only the part of the table in the batch's own time range is read (see
    ``new_rows``). ``partitions_follow_key`` says that equal keys lie in equal
    partitions, as with the day of a key's time: then only the batch's
    partitions are read, as is the case when the partition columns are keys.
    ``within`` = (key column, start, end) cuts the table besides.
    """
    from . import filters as flt
    if not table_exists(spark, ref, batch.schema, partition_by):
        write_append(dedup_first_wins(batch, keys, order_by), ref, partition_by)
        return
    batch = aligned(batch, spark, ref)
    target, parts = read_table(spark, ref), partition_columns(spark, ref)
    if within:
        if within[0] not in keys:
            raise ValueError(f"{within[0]} is not a key: rows outside the range may hold one of the batch's keys")
        target = flt.in_range(target, *within)
    follow = parts if partitions_follow_key or set(parts) <= set(keys) else ()
    with new_rows(batch, target, keys, order_by, follow) as rows:
        _insert(aligned(rows, spark, ref), ref)


def insert_if_period_absent(spark: SparkSession, df: DataFrame, ref: str, period_col: str,
                            period_value, partition_by=None) -> bool:
    """W6 / J6 — append the period only if the table has no row for it. True if written."""
    if table_exists(spark, ref, df.schema, partition_by):
        t = read_table(spark, ref)
        if not t.filter(F.col(period_col) == F.lit(period_value).cast(
                t.schema[period_col].dataType)).isEmpty():
            return False
    write_append(df, ref, partition_by)
    return True


def load_if_partition_empty(spark: SparkSession, df: DataFrame, ref: str,
                            partition_by) -> bool:
    """W7 — append only when every partition ``df`` would write is still empty."""
    if table_exists(spark, ref, df.schema, partition_by):
        periods = df.select(*partition_by).distinct()
        if not read_table(spark, ref).join(periods, list(partition_by), "left_semi").isEmpty():
            return False
    write_append(df, ref, partition_by)
    return True
