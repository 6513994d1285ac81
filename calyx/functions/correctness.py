"""The conventions for turning a raw 0/1/NULL "is correct" flag into a value
(P2a–P2d) and for counting failed attempts.

They differ on purpose and are kept apart: with (true, false, NULL),
``count(when(ok, NULL).otherwise(1))`` is 2, ``count(when(not ok, 1))`` is 1,
``sum(when(ok, 0).otherwise(1))`` is 2, ``count(ok)`` is 2, ``count(*)`` is 3.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# P2a — only the value 1 is true; NULL and anything else are false.
def correct_null_as_false(raw) -> Column:
    return F.coalesce(_c(raw) == 1, F.lit(False))


# P2b — truthiness: non-zero is true, NULL (missing) is false.
def correct_truthy(raw) -> Column:
    return F.coalesce(_c(raw) != 0, F.lit(False))


# P2c — keep NULL, else truthiness (three-valued).
def correct_three_valued(raw) -> Column:
    return _c(raw) != 0


# P2d — keep the raw 0/1/NULL integer, compare with 1 later.
def correct_raw_int(flag) -> Column:
    """From a BOOLEAN flag back to the 0/1/NULL integer form."""
    return F.when(_c(flag), 1).when(~_c(flag), 0).cast("int")


# Counting conventions for failed attempts ----------------------------------

def failed_null_counts(ok) -> Column:
    """``COUNT(CASE WHEN ok THEN NULL ELSE 1 END)``: NULL counts as failed."""
    return F.count(F.when(_c(ok), F.lit(None)).otherwise(F.lit(1)))


def failed_three_valued(ok) -> Column:
    """``COUNT(CASE WHEN NOT ok THEN 1 END)``: NULL is neither correct nor failed."""
    return F.count(F.when(~_c(ok), 1))


def failed_sum_zero(ok) -> Column:
    """``SUM(CASE WHEN NOT ok THEN 1 ELSE 0 END)``: NULL adds 0; NULL on empty input."""
    return F.sum(F.when(~_c(ok), 1).otherwise(0)).cast("long")


def correct_count(ok) -> Column:
    """``COUNT(CASE WHEN ok THEN 1 END)``."""
    return F.count(F.when(_c(ok), 1))


def correct_sum(ok) -> Column:
    """``SUM(CASE WHEN ok THEN 1 ELSE 0 END)`` (NULL on empty input)."""
    return F.sum(F.when(_c(ok), 1).otherwise(0)).cast("long")
