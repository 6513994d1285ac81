"""Joins J1, J3–J7 as DataFrame joins.

The reference probes row by row (N+1 queries) or relies on a unique index;
here each is one shuffle join whose strategy Catalyst and AQE choose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import filters as flt


def null_key(keys) -> F.Column:
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return cond


def _first_per_key(batch: DataFrame, keys, order_by) -> DataFrame:
    order = [c for c in order_by if c not in keys] or list(batch.columns)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return batch.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def dedup_first_wins(batch: DataFrame, keys, order_by) -> DataFrame:
    """J4 — one row per key: the first by ``order_by`` (arrival order) wins.

    ``row_number() = 1`` is planned with a group limit before the shuffle: each
    task keeps its first row of a key, so a key holding a third of all rows
    travels as one row per task.  The result stays partitioned by the key, so
    a join on it needs no other shuffle.  Rows with a NULL key never conflict
    (unique constraints ignore NULLs) and are all kept.
    """
    keys = list(keys)
    first = _first_per_key(batch.filter(~null_key(keys)), keys, order_by)
    if not any(batch.schema[k].nullable for k in keys):
        return first
    return first.unionByName(batch.filter(null_key(keys)))


def anti_new_rows(batch: DataFrame, target: DataFrame, keys, order_by, within=None) -> DataFrame:
    """J3 — rows of ``batch`` whose key is not yet in ``target`` (in-batch first wins).

    ``within`` = (key column, start, end): the range of that key the batch lies
    in, which prunes the scan of ``target``.  Dedup and anti join share one
    shuffle of the batch.
    """
    keys = list(keys)
    if within:
        if within[0] not in keys:
            raise ValueError(f"{within[0]} is not a key: rows outside the range may hold one of the batch's keys")
        target = flt.in_range(target, *within)
    known = target.select(*keys)
    first = _first_per_key(batch.filter(~null_key(keys)), keys, order_by).join(known, keys, "left_anti")
    if any(batch.schema[k].nullable for k in keys):
        first = first.unionByName(batch.filter(null_key(keys)))
    return first.select(*batch.columns)


def upsert_frames(target: DataFrame, source: DataFrame, keys) -> DataFrame:
    """J5 — ``ON CONFLICT DO UPDATE``: target rows without a source row, plus all source rows."""
    keys = list(keys)
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.unionByName(source.select(*target.columns))
