"""Quality and readiness checks Q1–Q10 as DataFrames.

Checks return small result frames computed by distributed aggregations
(one row per check), so they can be written, exported or asserted on.
Several columns are checked in **one** aggregation pass (Q6), and several
tables by a union of per-table counts (Q2, Q3).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class QualityError(RuntimeError):
    pass


# Q1 / Q8 / Q9
def has_rows(df: DataFrame) -> bool:
    """True when ``df`` has at least one row (a LIMIT 1 job, not a count)."""
    return not df.isEmpty()


def readiness_frame(spark: SparkSession, sources: dict, min_rows: int = 1) -> DataFrame:
    """Per source: name, whether it exists, its row count and whether count >= min_rows.

    ``sources`` maps a name to a DataFrame, or to None for a missing table.
    """
    parts = []
    for name, df in sources.items():
        if df is None:
            parts.append(spark.range(1).select(F.lit(name).alias("source"),
                                               F.lit(False).alias("table_exists"),
                                               F.lit(0).cast("long").alias("row_count")))
        else:
            parts.append(df.agg(F.count(F.lit(1)).alias("row_count"))
                         .select(F.lit(name).alias("source"), F.lit(True).alias("table_exists"),
                                 "row_count"))
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("ready", F.col("table_exists") & (F.col("row_count") >= F.lit(min_rows)))


def ready(spark: SparkSession, sources: dict, min_rows: int = 1, mode: str = "all") -> DataFrame:
    """Q2 (``mode='all'``) / Q3 (``'any'``): one row with the overall readiness."""
    agg = F.bool_and("ready") if mode == "all" else F.bool_or("ready")
    f = readiness_frame(spark, sources, min_rows)
    return f.agg(agg.alias("ready"), F.count(F.lit(1)).alias("sources_checked"),
                 F.count_if("ready").alias("sources_ready"))


def ready_in_order(spark: SparkSession, sources: dict, min_rows: int = 1, mode: str = "all") -> DataFrame:
    """Q2 / Q3 with short-circuit: one row (ready, sources_checked, last_source).

    Sources are probed in order; ``all`` stops at the first that is not ready,
    ``any`` at the first that is, and the sources after it are not read. A
    source is a DataFrame, None for a missing table, or a function that gives
    either (so that a source not probed is not even looked up). A probe ends
    after ``min_rows`` rows of each partition.
    """
    ready, checked, name = mode == "all", 0, None
    for name, source in sources.items():
        df = source() if callable(source) else source
        checked += 1
        if df is None:
            ready = False
        elif min_rows <= 1:
            ready = min_rows < 1 or not df.isEmpty()
        else:
            ready = df.select(F.lit(1)).limit(min_rows).count() >= min_rows
        if ready != (mode == "all"):
            break
    return spark.createDataFrame([(ready, checked, name)], "ready boolean, sources_checked long, last_source string")


# Q4
def partition_is_empty(df: DataFrame, spec: dict) -> bool:
    cond = reduce(lambda a, b: a & b,
                  [F.col(k) == F.lit(v).cast(df.schema[k].dataType) for k, v in spec.items()])
    return df.filter(cond).isEmpty()


def partition_emptiness(df: DataFrame, periods: DataFrame, period_col: str) -> DataFrame:
    """Q4 as a frame: for each requested period, its row count and whether it is empty."""
    counts = df.groupBy(period_col).agg(F.count(F.lit(1)).alias("row_count"))
    return (periods.join(counts, period_col, "left")
            .select(period_col, F.coalesce("row_count", F.lit(0)).cast("long").alias("row_count"))
            .withColumn("is_empty", F.col("row_count") == 0))


# Q5
def min_rows_check(df: DataFrame, min_rows: int, name: str = "table") -> DataFrame:
    return (df.agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.lit(name).alias("table_name"), "row_count",
                    F.lit(min_rows).cast("long").alias("min_rows"),
                    (F.col("row_count") >= min_rows).alias("passed")))


def assert_min_rows(df: DataFrame, min_rows: int, name: str = "table") -> int:
    """Fail when ``df`` has fewer than ``min_rows`` rows; returns the count."""
    n = df.count()
    if n < min_rows:
        raise QualityError(f"{name}: {n} rows < required {min_rows}")
    return n


def _named(column: str) -> F.Column:
    """The column of just this name, whatever characters it holds."""
    return F.col("`" + column.replace("`", "``") + "`")


# Q6
def null_pct(df: DataFrame, max_pct: dict) -> DataFrame:
    """NULL share in % (rounded half-up to 2) per column, checked against a maximum.

    One aggregation computes ``count(*)`` and ``count(c)`` for every column;
    an array of structs turns the single row into one row per column.  No rows
    gives a NULL share, which passes.
    """
    cols = list(max_pct)
    one = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count(_named(c)).alias(f"_c{i}") for i, c in enumerate(cols)])
    return _shares(one, max_pct)


def null_shares(spark: SparkSession, rows: int, filled: dict, max_pct: dict) -> DataFrame:
    """Q6 from counts at hand (all rows, and rows with a value per column), as observed while rows were written."""
    one = spark.createDataFrame([(rows, *(filled[c] for c in max_pct))],
                                ", ".join(["_n long", *(f"_c{i} long" for i in range(len(max_pct)))]))
    return _shares(one, max_pct)


def _shares(one: DataFrame, max_pct: dict) -> DataFrame:
    from ..functions.ratios import half_up_ratio
    long = one.select("_n", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), (F.col("_n") - F.col(f"_c{i}")).alias("null_count"),
                 F.lit(float(max_pct[c])).alias("max_null_pct"))
        for i, c in enumerate(max_pct)])).alias("_x")).select("_n", "_x.*")
    pct = half_up_ratio("null_count", "_n", scale=2, times=100, precision=5)
    return (long.select("column_name", F.col("null_count").cast("long").alias("null_count"),
                        pct.alias("null_pct"), "max_null_pct")
            .withColumn("passed", F.coalesce(F.col("null_pct").cast("double")
                                             <= F.col("max_null_pct"), F.lit(True))))


# Q7
def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys occurring more than once (UNIQUE constraint check)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
            .filter(F.col("occurrences") > 1))


def domain_violations(df: DataFrame, domains: dict) -> DataFrame:
    """Rows outside the allowed values per column (CHECK constraint), NULL allowed."""
    one = df.agg(*[F.count_if(_named(c).isNotNull() & ~_named(c).isin(list(v))).alias(f"_c{i}")
                   for i, (c, v) in enumerate(domains.items())])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_c{i}").alias("violations"))
        for i, c in enumerate(domains)])).alias("_x")).select("_x.*")


# Q10 — affected-row count of a write, observed while writing (no second pass)
def observed(df: DataFrame, name: str = "written"):
    """Attach an observation counting rows as they flow into a write.

    Returns ``(df_with_observation, observation)``; after the action,
    ``observation.get`` holds ``{'rows': n}``.
    """
    from pyspark.sql import Observation
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
