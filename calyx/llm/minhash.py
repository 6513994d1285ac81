"""MinHash near-duplicates: one-permutation hashing, optimal densification, star edges.

Plan: one pass hashes every text into its shingle set and 512-bin one-permutation
signature (empty bins copy a filled bin chosen by a hash sequence of their own),
folded to 64 band keys of 8 bins. Texts with equal sets are grouped first, one
representative goes on. A band bucket emits a star: its best-connected member,
the centre, with every other, so candidates are linear in the bucket. A star edge
is decided on the full shingle sets, and yields the member's difference from the
centre, the shingles that only one of the two has.

Links between two members that are not both linked to their centre are found
from these differences alone: |x ^ y| = |dx| + |dy| - 2 |dx & dy| for differences
dx, dy from one centre, exactly. So members that fail their centre are joined
with its other members on the centre, the join's condition is the exact test,
and only links leave it: the star loses no link between candidates.

At the threshold (0.8) a pair shares a band with probability
1 - (1 - 0.8**8)**64, a miss in about 130,000; above it, misses vanish quickly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, map_arrow, mix, only_marked, shingle_sets, write_table

BANDS, ROWS = 64, 8


class Densifier:
    """Signatures of sorted shingle sets: minimum per bin, empty bins filled by hashed probing."""

    def __init__(self, bands: int, rows: int):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        rng = np.random.default_rng(11)
        self.fold = rng.integers(1, 2**63, rows, dtype=np.uint64) | np.uint64(1)
        self.salt = mix(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.seed = mix(np.arange(self.bins, dtype=np.uint64) + np.uint64(77))
        self.step, self.tables = np.uint64(0xD6E8FEB86659FD93), []

    def probes(self, block: int) -> np.ndarray:
        """(16, bins): the bins that each empty bin tries, 16 attempts a block."""
        while len(self.tables) <= block:
            attempt = np.arange(16 * len(self.tables), 16 * len(self.tables) + 16, dtype=np.uint64) + np.uint64(1)
            self.tables.append((mix(self.seed[None, :] + (attempt * self.step)[:, None])
                                % np.uint64(self.bins)).astype(np.int64))
        return self.tables[block]

    def signature(self, s: np.ndarray) -> np.ndarray:
        """``s``: sorted distinct 64-bit hashes, at least one."""
        bins = ((s >> np.uint64(32)) * np.uint64(self.bins) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], bins[1:] != bins[:-1])))
        out, full = np.zeros(self.bins, np.uint64), np.zeros(self.bins, bool)
        out[bins[first]] = s[first]
        full[bins[first]] = True
        empty, block = np.flatnonzero(~full), 0
        while len(empty):
            at = self.probes(block)[:, empty]
            hit = full[at]
            k = hit.argmax(0)
            pick = np.arange(len(empty))
            got = hit[k, pick]
            out[empty[got]] = out[at[k, pick][got]]
            empty, block = empty[~got], block + 1
        return out

    def keys(self, s: np.ndarray) -> np.ndarray:
        folded = (mix(self.signature(s)).reshape(self.bands, self.rows) * self.fold).sum(axis=1, dtype=np.uint64)
        return mix(folded + self.salt).view(np.int64)


def _signed(batches, k: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    dense = Densifier(bands, rows)
    for batch in batches:
        ids, n, prints, keys, offsets = batch.column(0), [], [], [], [0]
        for s in shingle_sets(batch.column(1), k):
            n.append(len(s))
            if len(s):
                keys.append(dense.keys(s))
                m = mix(s + np.uint64(99))
                prints.append(np.array([m.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(m))], np.uint64).tobytes())
            else:
                prints.append(None)
            offsets.append(offsets[-1] + (bands if len(s) else 0))
        flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        yield pa.record_batch([ids, pa.array(n, pa.int64()), pa.array(prints, pa.binary()),
                               pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))],
                              names=["id", "n", "print", "keys"])


def signatures(docs: DataFrame, id_col: str, text_col: str, k: int,
               bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, n, print, keys) per row: set size, 128-bit fingerprint of the set, band keys."""
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_arrow(base, lambda it: _signed(it, k, bands, rows),
                     "id long, n long, print binary, keys array<long>")


def _decided(batches, k: int) -> Iterator[pa.RecordBatch]:
    last_id, last = None, None
    for batch in batches:
        centre, n, m, delta, offsets = batch.column(0).to_pylist(), [], [], [], [0]
        for i, y in enumerate(shingle_sets(batch.column(3), k)):
            if centre[i] != last_id:
                last_id, last = centre[i], next(shingle_sets(batch.column(2).slice(i, 1), k))
            d = np.setxor1d(last, y, assume_unique=True)
            n.append(len(last))
            m.append(len(y))
            delta.append(d)
            offsets.append(offsets[-1] + len(d))
        flat = np.concatenate(delta).view(np.int64) if delta else np.zeros(0, np.int64)
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(m, pa.int64()),
                               pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))],
                              names=["centre", "id", "centre_n", "n", "delta"])


def _decide(stars: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """(centre, id, centre_n, n, delta): sizes of both full shingle sets, and what only one of them has."""
    one = texts.select(F.col("id").alias("centre"), F.col("text").alias("centre_text"))
    rows = stars.join(texts, "id").join(one, "centre").select("centre", "id", "centre_text", "text")
    return map_arrow(rows, lambda it: _decided(it, k),
                     "centre long, id long, centre_n long, n long, delta array<long>")


def _alike(x, y, apart, percent: int):
    """Whether sets of ``x`` and ``y`` elements that differ in ``apart`` reach the similarity; no rounding."""
    return 100 * (x + y - apart) >= percent * (x + y + apart)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                    percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, n_shingles, component_id, kept) per row of ``docs``.

    Two texts are linked when 100 * |A and B| >= ``percent`` * |A or B| over
    their distinct ``k``-word shingles (lower-cased A-Z, words split at ASCII
    white space; fewer than ``k`` words: the whole sequence is the one
    shingle). component_id is the smallest id reachable over links; kept marks
    the row whose id that is. Null, empty and wordless texts have no shingles
    and link with nothing. Rows with a null id are returned with null
    component_id and kept true: they can't be named, so nothing is dropped for
    them. Repeated rows form one component; rows that repeat an id with
    different texts are one node. Only the two named columns are read.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed = write_table(signatures(base, "id", "text", k, bands, rows), "signatures")
    known = signed.filter("id is not null and print is not null")
    groups = known.groupBy("print").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    copies = known.select("id", "print").join(
        groups.filter("copies > 1"), "print").filter("id > rep").select("id", "rep").distinct()
    copies = write_table(copies, "copies")

    reps = known.join(copies.select("id"), "id", "left_anti")
    band = reps.select("id", F.explode("keys").alias("key"))
    shared = band.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"),
                                     F.count("*").alias("size")).filter("lo < hi")
    member = write_table(band.join(shared, "key").select("key", "id", "size"), "buckets")
    # the centre of a star is the member that meets most others over all bands: an original among its copies
    degree = member.groupBy("id").agg(F.sum("size").alias("degree"))
    ranked = member.join(degree, "id").withColumn("best", F.struct("degree", (-F.col("id")).alias("less")))
    centre = ranked.groupBy("key").agg((-F.max("best")["less"]).alias("centre"))
    stars = write_table(member.join(centre, "key").filter(F.col("id") != F.col("centre"))
                        .select("centre", "id").distinct(), "stars")
    ends = stars.select(F.explode(F.array("centre", "id")).alias("end")).distinct()
    texts = only_marked(base.filter("id is not null and text is not null"), "id", ends)
    decided = write_table(_decide(stars, texts, k).withColumn(
        "linked", _alike(F.col("centre_n"), F.col("n"), F.size("delta"), percent)), "decided")

    failed = decided.filter("not linked").select(
        "centre", F.col("id").alias("x"), F.col("n").alias("xn"), F.col("delta").alias("dx"))
    other = decided.select("centre", F.col("id").alias("y"), F.col("n").alias("yn"), F.col("delta").alias("dy"),
                           F.col("linked").alias("yl"))
    dx, dy, xn, yn = F.size("dx"), F.size("dy"), F.col("xn"), F.col("yn")
    pair = ((F.col("x") != F.col("y")) & (F.col("yl") | (F.col("x") < F.col("y")))
            & _alike(xn, yn, F.abs(dx - dy), percent))                           # at best the smaller lies in the larger
    exact = _alike(xn, yn, dx + dy - 2 * F.size(F.array_intersect("dx", "dy")), percent)
    beside = failed.alias("f").join(other.alias("o"), (F.col("f.centre") == F.col("o.centre")) & pair & exact) \
        .select(F.col("x").alias("a"), F.col("y").alias("b"))
    links = decided.filter("linked").select(F.col("centre").alias("a"), F.col("id").alias("b")).unionByName(beside)
    part = components(links)

    of_copy = copies.join(part, F.col("rep") == F.col("node"), "left") \
        .select("id", F.coalesce("component", "rep").alias("component"))
    placed = of_copy.unionByName(part.select(F.col("node").alias("id"), "component")) \
        .groupBy("id").agg(F.min("component").alias("component"))
    return signed.select("id", "n").join(placed, "id", "left").select(
        "id", F.col("n").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id"),
        F.coalesce(F.coalesce("component", "id") == F.col("id"), F.lit(True)).alias("kept"))
