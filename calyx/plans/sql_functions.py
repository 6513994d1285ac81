"""SQL functions for spec authors (Spark SQL-defined functions: they are
inlined into the plan as ordinary expressions — no Python runs).

* ``calyx_ratio(k, n, s, m)`` = round_half_up(k * m / n, s), NULL when n = 0,
  for whole numbers k >= 0, n > 0 (the exact form of
  ``ROUND(AVG(CASE WHEN ok THEN 1.0 ELSE 0.0 END) * m, s)``).
* ``calyx_avg(total, n, s)`` = round_half_up(total / n, s) for a DECIMAL
  total with at most 2 decimals (``ROUND(AVG(x)::numeric, s)``).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

_RATIO = """
CREATE OR REPLACE TEMPORARY FUNCTION calyx_ratio(k DECIMAL(38, 0), n DECIMAL(38, 0), s INT, m INT)
RETURNS DECIMAL(38, 6)
RETURN CAST(CAST(
    (CAST(2 * k * m * CAST(power(10, s) AS DECIMAL(38, 0)) + n AS DECIMAL(38, 0))
     - CAST(2 * k * m * CAST(power(10, s) AS DECIMAL(38, 0)) + n AS DECIMAL(38, 0)) % nullif(2 * n, 0))
    / nullif(2 * n, 0) AS DECIMAL(38, 0)) / CAST(power(10, s) AS DECIMAL(38, 0)) AS DECIMAL(38, 6))"""

_AVG = """
CREATE OR REPLACE TEMPORARY FUNCTION calyx_avg(total DECIMAL(38, 2), n BIGINT, s INT)
RETURNS DECIMAL(38, 6)
RETURN calyx_ratio(CAST(total * 100 AS DECIMAL(38, 0)), CAST(n AS DECIMAL(38, 0)) * 100, s, 1)"""


def register_sql_functions(spark: SparkSession) -> None:
    spark.sql(_RATIO)
    spark.sql(_AVG)
