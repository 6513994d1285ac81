"""Running sums along sorted rows, without gathering a key in one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from .common import map_arrow, write_table

#: sums are taken modulo 2**56, so that 128 of them still add up in a long
MASK = (1 << 56) - 1


def _local(batches, key: str, sums: list[str]) -> Iterator[pa.RecordBatch]:
    """Adds seq and, per sum, the total of the rows before within this partition's run of the key."""
    last, seq = None, 0
    carry = [0] * len(sums)
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        new = np.empty(n, bool)
        new[0] = last is None or keys[0] != last
        new[1:] = keys[1:] != keys[:-1]
        run = np.cumsum(new) - 1                          # -1: the run that the batch before left open
        starts = np.flatnonzero(new)
        added = []
        for i, name in enumerate(sums):
            v = batch.column(name).to_numpy(zero_copy_only=False).astype(np.uint64)
            total = np.cumsum(v, dtype=np.uint64)
            before = total - v
            base = np.append(before[starts], np.uint64(0))     # run -1 reads the appended last one
            held = np.append(np.zeros(len(starts), np.uint64), np.uint64(carry[i]))
            mine = (before - base[run] + held[run]) & np.uint64(MASK)
            carry[i] = (int(mine[-1]) + int(v[-1])) & MASK
            added.append(pa.array(mine.astype(np.int64)))
        last = keys[-1]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.arange(seq, seq + n)), *added],
                                         names=[*batch.schema.names, "__seq", *(f"before_{s}" for s in sums)])
        seq += n


def running(rows: DataFrame, key: str, order: list[Column | str], sums: list[str]) -> DataFrame:
    """``rows`` with ``before_<s>`` for each long column of ``sums``: its total over the key's earlier rows, mod 2**56.

    Rows are dealt out by ranges of (key, order), so that a key of any size
    spreads over many tasks; each task sums along its own rows, and what a key
    has gathered in earlier ranges is added afterwards. Of each range two rows
    come to the driver. Rows equal in key and order stand in any order; null
    keys are left out.
    """
    spark = rows.sparkSession
    dealt = rows.filter(F.col(key).isNotNull()).repartitionByRange(key, *order) \
        .sortWithinPartitions(key, *order).withColumn("__part", F.spark_partition_id())
    out = StructType(list(dealt.schema.fields))
    for name in ["__seq", *(f"before_{s}" for s in sums)]:
        out = out.add(name, LongType())
    local = write_table(map_arrow(dealt, lambda it: _local(it, key, sums), out), "running")
    upto = [((F.col(f"before_{s}") + F.col(s)).bitwiseAND(MASK)).alias(s) for s in sums]
    ends = local.groupBy("__part").agg(F.min(F.struct("__seq", key)).alias("a"),
                                       F.max(F.struct("__seq", key, *upto)).alias("z")).orderBy("__part").collect()
    carried, before = [], None                           # before: (key, totals) at the end of the range before
    for r in ends:
        first, last, totals = r["a"][1], r["z"][1], list(r["z"][2:])
        if before is not None and before[0] == first:
            carried.append((r["__part"], first, *before[1]))
            if first == last:
                totals = [(x + y) & MASK for x, y in zip(totals, before[1])]
        before = (last, totals)
    kind = StructType().add("__part", IntegerType()).add("__key", local.schema[key].dataType)
    for s in sums:
        kind = kind.add(f"__{s}", LongType())
    extra = spark.createDataFrame(carried, kind)         # at most a row for each range
    joined = local.join(F.broadcast(extra.withColumnRenamed("__part", "__p")),
                        (F.col("__part") == F.col("__p")) & (F.col(key) == F.col("__key")), "left")
    return joined.select(*rows.columns, *(
        (F.col(f"before_{s}") + F.coalesce(F.col(f"__{s}"), F.lit(0))).bitwiseAND(MASK).alias(f"before_{s}")
        for s in sums))
