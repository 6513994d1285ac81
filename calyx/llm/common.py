"""Helpers shared by the operators: written tables, word hashing in numpy, components.

Word and shingle hashing works on the bytes of many documents at once: Arrow
hands the text column over as one buffer, so there is no Python loop over words.
"""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from calyx.session import scratch_path

CHUNK_BYTES = 1 << 19          # bytes of text hashed at once; a longer text makes its own chunk
BATCH_BYTES = 4 << 20          # rows handed to Python at once; a longer row makes its own batch


# ---------------------------------------------------------- code on executors
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors' Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="calyx-code-"), "calyx_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent).as_posix())
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def map_arrow(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow`` with this package at hand on the executors.

    Texts are long rows of any length: batches are bounded in bytes, which bounds
    a Python worker's memory. Spark reads the bound when the plan runs, so it is
    a setting of the session; one given when the application started stays.
    """
    spark, key = df.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch"
    ship(spark)
    if not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, str(BATCH_BYTES))
    return df.mapInArrow(lambda batches: _released(fn, batches), schema)


def _released(fn: Callable, batches) -> Iterator:
    """``fn`` over a task's batches; then memory that it has freed goes back to the system, as workers live on."""
    yield from fn(batches)
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):             # a C library without it
        pass


# ------------------------------------------------------------ written tables
def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(_nullable(df.schema)).parquet(path)


def _nullable(schema: StructType) -> StructType:
    return StructType.fromJson({**schema.jsonValue(),
                                "fields": [{**f, "nullable": True}
                                           for f in schema.jsonValue()["fields"]]})


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# ------------------------------------------------------------- word hashing
_RNG = np.random.default_rng(20240607)
_ODD = np.uint64(1)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | _ODD
_BASE = int(_RNG.integers(1, 2**62)) * 8 + 3             # odd, so it has an inverse mod 2**64
_INVERSE = pow(_BASE, -1, 2**64)
_MULT = _RNG.integers(1, 2**63, 64, dtype=np.uint64) | _ODD
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: ``[^\x20\x09-\x0D]+`` and ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` over bytes: all separators are ASCII
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n mod 2**64; kept for the next text up to a chunk's length, and not beyond."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        run = np.full(max(n, CHUNK_BYTES) + 1, base, np.uint64)
        run[0] = 1
        have = np.cumprod(run, dtype=np.uint64)
        if n <= CHUNK_BYTES:
            _powers[base] = have
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (finaliser of the splitmix family)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string or binary column; nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    big = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64 if big else np.int32)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets.astype(np.int64)


def chunks(data: np.ndarray, offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple]:
    """(first document, last + 1, their bytes, offsets from 0), whole documents, about ``size`` bytes."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        j = min(j, n)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def words(raw: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray = NOT_SPACE,
          lower: bool = True, stems: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
    """Word hashes, starts, ends (bytes) and, per document, the index of its first word.

    A word is a maximal run of bytes marked in ``word_bytes`` inside one
    document. Then, for each of ``stems``, the hashes of the words' first bytes so many.
    """
    low = LOWER[raw] if lower else raw
    inside = word_bytes[low]
    n = len(low)
    if n == 0:
        z = np.zeros(0, np.int64)
        none = (np.zeros(0, np.uint64), z, z, np.zeros(len(offsets), np.int64))
        return none + (none[0],) * len(stems)
    edge = offsets[:-1][offsets[:-1] < n]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[edge] = False
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[edge[edge > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[low] * _power(_BASE, n)[:n], out=total[1:])
    shift = _power(_INVERSE, n)[starts]
    found = (mix((total[ends] - total[starts]) * shift), starts, ends,
             np.searchsorted(starts, offsets).astype(np.int64))
    return found + tuple(mix((total[np.minimum(ends, starts + k)] - total[starts]) * shift + np.uint64(k))
                         for k in stems)


def word_hash(word: str, lower: bool = True) -> int:
    """The hash ``words`` gives this word."""
    raw = np.frombuffer(word.encode(), np.uint8)
    h, *_ = words(raw, np.array([0, len(raw)]), np.ones(256, bool), lower)
    return int(h[0])


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words (fewer words: none)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = h[:n] * _MULT[0]
    for i in range(1, k):
        out += h[i:i + n] * _MULT[i]
    return mix(out)


def shingle_sets(column, k: int) -> Iterator[np.ndarray]:
    """Per text its sorted distinct ``k``-word shingles as 64-bit hashes.

    A text of fewer than ``k`` words has its whole word sequence as its one
    shingle; a null or wordless text has the empty set.
    """
    data, offsets = text_buffers(column)
    for i, j, raw, off in chunks(data, offsets):
        h, _, _, first = words(raw, off)
        all_shingles = shingle_hashes(h, k)
        for d in range(j - i):
            a, b = first[d], first[d + 1]
            if b - a >= k:
                s = np.sort(all_shingles[a:b - k + 1])
                keep = np.empty(len(s), bool)
                keep[0] = True
                np.not_equal(s[1:], s[:-1], out=keep[1:])
                yield s[keep]
            elif b > a:
                yield mix((h[a:b] * _MULT[1:1 + b - a]).sum(keepdims=True) + _MULT[40 + b - a:41 + b - a])
            else:
                yield np.zeros(0, np.uint64)


# -------------------------------------------------------------------- pruning
MARK_BITS = 23


def _mark(column: str):
    return F.expr(f"xxhash64({column}) & {(1 << MARK_BITS) - 1}L") + 1


def only_marked(rows: DataFrame, column: str, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    """The ``rows`` whose ``column`` may be in the one column of ``keys``: all that are, and a few others.

    ``keys`` becomes a bitmap over hashes of 2**MARK_BITS bits (1 MB), whatever
    its size, that is broadcast; a join that follows sorts out the others. With
    more keys than bits it prunes little, and only costs its pass. With
    ``how="left_anti"``, the other rows: those that are certainly not in ``keys``.
    """
    key = keys.columns[0]
    bits = keys.groupBy(F.bitmap_bucket_number(_mark(key)).alias("__bucket")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(_mark(key))).alias("__bits"))
    place = F.bitmap_bit_position(_mark(column))
    byte = F.conv(F.hex(F.substring("__bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(place, F.lit(8)))), F.lit(2)) == 1
    return rows.join(F.broadcast(bits), (F.bitmap_bucket_number(_mark(column)) == F.col("__bucket")) & hit, how)


def without(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """``rows`` less those whose ``column`` is in the one column of ``keys``; null ones stay.

    Only rows that a bitmap of the keys marks are shuffled for the exact join;
    long rows that stay, mostly, are not.
    """
    gone = keys.select(F.col(keys.columns[0]).alias("__gone")).filter("__gone is not null").distinct()
    named = rows.filter(F.col(column).isNotNull())
    maybe = only_marked(named, column, gone)
    left = maybe.join(gone, F.col(column) == F.col("__gone"), "left_anti")
    return only_marked(named, column, gone, "left_anti").unionByName(left) \
        .unionByName(rows.filter(F.col(column).isNull()))


def distinct_by(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``rows.dropDuplicates(columns)``, with ``key`` among them, where only rows of repeated keys are shuffled; null keys all stay."""
    named = rows.filter(F.col(key).isNotNull())
    twice = named.groupBy(key).count().filter("count > 1").select(key)
    return only_marked(named, key, twice, "left_anti") \
        .unionByName(only_marked(named, key, twice).dropDuplicates(columns)) \
        .unionByName(rows.filter(F.col(key).isNull()))


def smallest_hashes(rows: DataFrame, group: str, key: str, n: int) -> DataFrame:
    """(group, key): of each value of ``group`` the ``n`` keys with the smallest hashes, a sample that repeats.

    A group of m rows is first cut to the hashes below about 3n / m of them, so
    that no task ranks a whole group. A row for each group comes to the driver.
    """
    pairs = rows.select(group, key)
    cuts = [(g, min(2**63 - 1, int(-2**63 + min(1.0, (3 * n + 30) / m) * 2**64)))
            for g, m in pairs.groupBy(group).count().collect()]
    kind = StructType([pairs.schema[group]]).add("__cut", "long")
    near = pairs.join(F.broadcast(rows.sparkSession.createDataFrame(cuts, kind)), group) \
        .filter(F.xxhash64(key) <= F.col("__cut"))
    order = Window.partitionBy(group).orderBy(F.xxhash64(key), key)
    return near.withColumn("__r", F.row_number().over(order)).filter(F.col("__r") <= n).select(group, key)


# --------------------------------------------------------------- components
def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges`` (two long columns).

    Alternating large-star and small-star rounds; each is grouped minima and
    joins, written to the shared folder, until every node hangs on one root
    that hangs on nothing. Only the number of nodes that don't comes to the driver.
    """
    e = write_table(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v"), "edges")
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u and v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        e = write_table(small.filter("u > v").distinct(), "edges")
        ends = e.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")),
                                          F.struct(F.col("v").alias("node"), F.lit(0).alias("up")))).alias("x"))
        loose = ends.groupBy("x.node").agg(F.sum("x.up").alias("up"), F.min("x.up").alias("root")) \
            .filter("up > 1 or (up = 1 and root = 0)").count()
        if not loose:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
