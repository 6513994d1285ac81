"""Driver tables and the domain views built on them (SRC2, SRC3).

The reference's tables (attempts, café orders, purchases, sales, catalogue)
are derived from the TPC-H-like test tables by pure projections and joins, so
every query reads real data and its work grows with it.  All views are lazy;
filters applied on top reach the Parquet scan through the projection.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """SRC2 — full scan of one table (Catalyst prunes columns later)."""
    return spark.read.parquet(table_path(sf_dir, name))


def column_subset(df: DataFrame, cols=("*",)) -> DataFrame:
    """SRC3 — scan a named subset of columns; ``["*"]`` keeps all."""
    cols = list(cols)
    if cols == ["*"]:
        return df
    return df.select(*cols)


def _ts_range(c: Column, period) -> Column | None:
    if period is None:
        return None
    start, end = period
    return (c >= start.cast("timestamp_ntz")) & (c < end.cast("timestamp_ntz"))


# --------------------------------------------------------------------------
# Learning attempts (canonical attempt schema + lesson variant)
# --------------------------------------------------------------------------

def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per attempt.

    ``is_correct`` is three-valued: NULL for low values, else value >= 30.
    ``lesson_id`` comes from the JSON ``props`` column; it is only parsed when
    a query selects it (column pruning drops the expression otherwise).
    """
    return attempts_from_events(read_table(spark, sf_dir, "events"))


def attempts_from_events(ev: DataFrame) -> DataFrame:
    """The attempts projection of an events frame (batch or streaming)."""
    # a projection of its own: the JSON path is evaluated once for both columns made of it
    lesson = F.col("_lesson")
    return ev.withColumn("_lesson", F.get_json_object("props", "$.k")).select(
        F.col("event_id"),
        F.col("user_id").cast("string").alias("lti_user_id"),
        F.col("event_type").alias("attempt_type"),
        F.col("ts").alias("created_at"),
        F.when(F.col("value") < 5, F.lit(None).cast("boolean"))
         .otherwise(F.col("value") >= 30).alias("is_correct"),
        F.col("value").cast("decimal(10,2)").alias("score"),
        lesson.alias("lesson_id"),
        F.concat(F.lit("lesson "), lesson).alias("lesson_name"),
    )


# --------------------------------------------------------------------------
# Café orders, sales
# --------------------------------------------------------------------------

def cafe_orders(spark: SparkSession, sf_dir: str, period=None,
                with_manager: bool = False) -> DataFrame:
    """date × branch × dish order lines.

    ``period`` = (start, end) DATE columns restricts ``l_shipdate`` before the
    joins so the range is pushed to the lineitem scan.  Join strategies are
    Catalyst's: dimension sides under the broadcast threshold (by their
    file-size statistics) are broadcast, larger ones sort-merge, and AQE
    re-plans with the real sizes.
    """
    li = read_table(spark, sf_dir, "lineitem")
    cond = _ts_range(F.col("l_shipdate"), period)
    if cond is not None:
        li = li.filter(cond)
    part = read_table(spark, sf_dir, "part")
    supp = read_table(spark, sf_dir, "supplier")
    nation = read_table(spark, sf_dir, "nation")
    j = (li.join(part, li.l_partkey == part.p_partkey)
           .join(supp, li.l_suppkey == supp.s_suppkey)
           .join(nation, supp.s_nationkey == nation.n_nationkey))
    cols = [
        F.col("l_shipdate").cast("date").alias("report_date"),
        F.col("n_name").alias("branch"),
        F.col("p_type").alias("dish"),
        F.col("p_brand").alias("category"),
        F.col("l_quantity").cast("bigint").alias("qty"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("amount"),
    ]
    if with_manager:
        cols.append(F.col("s_name").alias("manager_name"))
    return j.select(*cols)


def sales(spark: SparkSession, sf_dir: str, period=None) -> DataFrame:
    """category_name, manager_name, price, sale_date (from café order lines)."""
    return cafe_orders(spark, sf_dir, period, with_manager=True).select(
        F.col("category").alias("category_name"), "manager_name", "price",
        F.col("report_date").alias("sale_date"))


# --------------------------------------------------------------------------
# Subscription purchases
# --------------------------------------------------------------------------

def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("purchase_id"),
        F.col("o_custkey").alias("client_id"),
        F.col("o_orderdate").cast("date").alias("purchase_date"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "year")
         .when(F.col("o_orderpriority") == "2-HIGH", "trial")
         .otherwise("month").alias("subscription_plan"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
        F.col("o_orderpriority").alias("payment_method"),
        F.when(F.col("o_orderstatus") == "F", "success")
         .when(F.col("o_orderstatus") == "O", "failed")
         .otherwise("refund").alias("status"),
        F.col("o_orderdate").alias("_purchase_ts"),
    )


# --------------------------------------------------------------------------
# Catalogue (products, categories) and the numbered series
# --------------------------------------------------------------------------

def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("product_id"),
                    F.col("p_name").alias("product"),
                    F.col("p_brand").alias("category_id"),
                    F.col("p_size").cast("int").alias("units_in_stock"))


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return (p.select(F.col("p_brand").alias("category_id")).distinct()
             .withColumn("category_name",
                         F.regexp_replace("category_id", "^Brand#", "Category ")))


def series_rows(ids: DataFrame, id_col: str = "id") -> DataFrame:
    """SRC5 rule: id, ``Category_{id % 5}``, amount = id * 10.5 stored as an integer.

    The reference assigns 10.5·id to an INT column, which rounds half away
    from zero; BIGINT keeps large ids from overflowing.
    """
    # The rule's five categories and its factor of 10.5.
    i = F.col(id_col).cast("long")
    return ids.select(
        i.alias("id"),
        F.concat(F.lit("Category_"), F.pmod(i, F.lit(5)).cast("string")).alias("category"),
        F.round(i.cast("decimal(20,1)") * F.lit(10.5).cast("decimal(3,1)"), 0)
         .cast("bigint").alias("amount"),
    )


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The series rule applied to every order: id = o_orderkey + 1."""
    o = read_table(spark, sf_dir, "orders")
    return series_rows(o.select((F.col("o_orderkey") + 1).alias("id")))


def generated_series(spark: SparkSession, n: int = 50) -> DataFrame:
    """SRC5 as in the reference: ids 1..n from ``spark.range``."""
    return series_rows(spark.range(1, n + 1))
