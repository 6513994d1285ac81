"""Approximate nearest neighbours by cosine: inverted multi-index over two vector halves.

Unit vectors are cut in halves, each half quantised by a codebook of its own
(k-means in numpy on a bounded sample); a cell is a pair of codewords. A query
takes cells in order of summed half distances, popped from a heap, until the
cells hold enough entries. How many are enough is measured in each table: so many
that a sample of its queries finds the wanted share of its exact neighbours. The
entries are reranked by the exact cosine of
the original vectors in double precision. A query's cells with one first codeword are
one row, with the second codewords as bits. Entries of a first codeword and the
queries that visit it are dealt to tasks in blocks of bounded size, so a crowded
or much visited one is many blocks; a block is one product of two matrices. Of
equal vectors only as many as can appear in a result take part.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, write_table

SAMPLE = 20_000                # vectors that fit the codebooks, those with the smallest hashes
RECALL = 0.97                  # share of the exact neighbours that the sampled queries must find
PROBES = 200                   # sampled queries, those with the smallest hashes
TOP = 5
BLOCK = 2048                   # entries, and visiting queries, of a cell that meet at once


def codebook(x: np.ndarray, k: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """k-means centroids of the rows of ``x`` (at most ``k``)."""
    rng = np.random.default_rng(seed)
    x = np.unique(x, axis=0)
    centre = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = _distances(x, centre).argmin(1)
        n = np.bincount(near, minlength=len(centre))
        total = np.zeros_like(centre)
        np.add.at(total, near, x)
        full = n > 0
        centre[full] = total[full] / n[full, None]
    return centre


def _distances(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * (x @ centre.T) + (centre * centre).sum(1)[None, :]


def _halves(x: np.ndarray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """The two halves of vectors; a single component is both."""
    return x[:, :max(1, dim // 2)], x[:, dim // 2:]


def nearest_cells(near1: np.ndarray, near2: np.ndarray, counts: np.ndarray, enough: int) -> list[int]:
    """Cells of one query by summed distance, each of the two given per codeword, until they hold ``enough``."""
    order1, order2 = near1.argsort(kind="stable"), near2.argsort(kind="stable")
    k2 = len(order2)
    heap, pushed = [(near1[order1[0]] + near2[order2[0]], 0, 0)], {(0, 0)}
    held, cells = 0, []
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = int(order1[i]) * k2 + int(order2[j])
        if counts[cell]:
            held += int(counts[cell])
            cells.append(cell)
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(order1) and b < k2 and (a, b) not in pushed:
                pushed.add((a, b))
                heapq.heappush(heap, (near1[order1[a]] + near2[order2[b]], a, b))
    return cells


def _unit(column: pa.Array, dim: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1))[:, None]


def _assigned(batches, dim: int, book1: np.ndarray, book2: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cells = np.zeros(0, np.int64)
        if len(batch):
            one, two = _halves(_unit(batch.column(1), dim), dim)
            cells = _distances(one, book1).argmin(1) * len(book2) + _distances(two, book2).argmin(1)
        yield pa.record_batch([*batch.columns, pa.array(cells, pa.int64())], names=["id", "vector", "norm", "cell"])


def _visits(batches, dim: int, book1, book2, counts: np.ndarray, enough: int) -> Iterator[pa.RecordBatch]:
    """(id, first, seconds): per query and first codeword, the second codewords of the cells to visit, as bits."""
    for batch in batches:
        query, first, seconds = [], [], []
        if len(batch):
            one, two = _halves(_unit(batch.column(1), dim), dim)
            near1, near2 = _distances(one, book1), _distances(two, book2)
            for i in range(len(batch)):
                wanted = np.zeros((len(book1), len(book2)), bool)
                wanted.ravel()[nearest_cells(near1[i], near2[i], counts, enough)] = True
                for k in np.flatnonzero(wanted.any(1)):
                    query.append(i)
                    first.append(int(k))
                    seconds.append(np.packbits(wanted[k]).tobytes())
        yield pa.record_batch([batch.column(0).take(pa.array(query, pa.int64())), pa.array(first, pa.int32()),
                               pa.array(seconds, pa.binary())], names=["id", "first", "seconds"])


def _exact(batches, dim: int, top: int, ids: np.ndarray, probes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Each probe's nearest entries of a task, with their cells."""
    score, cell = np.full((len(ids), top), -np.inf), np.full((len(ids), top), -1)
    for batch in batches:
        if not len(batch):
            continue
        near = probes @ _unit(batch.column(1), dim).T
        near[ids[:, None] == batch.column(0).to_numpy()[None, :]] = -np.inf
        near = np.concatenate([score, near], 1)
        cells = np.concatenate([cell, np.broadcast_to(batch.column(3).to_numpy(), (len(ids), len(batch)))], 1)
        best = np.argsort(-near, axis=1, kind="stable")[:, :top]
        score, cell = np.take_along_axis(near, best, 1), np.take_along_axis(cells, best, 1)
    q, k = np.nonzero(score > -np.inf)
    yield pa.record_batch([pa.array(q, pa.int64()), pa.array(score[q, k]), pa.array(cell[q, k], pa.int64())],
                          names=["probe", "score", "cell"])


def enough_for(index: DataFrame, queries: DataFrame, dim: int, book1: np.ndarray, book2: np.ndarray,
               counts: np.ndarray, top: int, recall: float, probes: int = PROBES) -> int:
    """Entries a query's cells must hold so that ``recall`` of the sampled queries' exact neighbours are among them.

    The sampled queries are held against the whole index; ``probes`` times
    ``top`` rows come to the driver.
    """
    some = queries.select("id", "vector", F.xxhash64("id").alias("h")).orderBy("h", "id").limit(probes).collect()
    if not some:
        return 0
    ids = np.array([r["id"] for r in some])
    x = np.array([r["vector"] for r in some], np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    x /= np.sqrt((x * x).sum(1))[:, None]
    best = Window.partitionBy("probe").orderBy(F.desc("score"), "cell")
    near = map_arrow(index, lambda it: _exact(it, dim, top, ids, x), "probe long, score double, cell long") \
        .withColumn("r", F.row_number().over(best)).filter(F.col("r") <= top).select("probe", "cell").collect()
    one, two = _halves(x, dim)
    near1, near2 = _distances(one, book1), _distances(two, book2)
    cells: dict[int, list[int]] = {}
    for probe, cell in near:
        cells.setdefault(probe, []).append(cell)
    held = []
    for probe, own in cells.items():
        far = (near1[probe][:, None] + near2[probe][None, :]).ravel()
        held.extend(int(counts[far <= far[c]].sum()) for c in own)
    return int(np.sort(held)[max(0, int(np.ceil(recall * len(held))) - 1)]) if held else 0


def _reranked(batches, dim: int, top: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block, a block's entries (kind 0) before its queries (1): each query's best of the block.

    A block holds entries of one first codeword; of these a query sees those in
    the cells that it visits. Entries that tie with the last of the best come
    along; the sum of products runs alike for every pair, so equal vectors get
    equal scores.
    """
    held_key, held = None, []
    for batch in batches:
        if not len(batch):
            continue
        keys = np.stack([batch.column(k).to_numpy() for k in range(3)])
        kind, ids, norm, second = (batch.column(k).to_numpy() for k in (3, 4, 6, 7))
        x = batch.column(5).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
        cut = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0) | (kind[1:] != kind[:-1])) + 1
        out = []
        for a, b in zip([0, *cut], [*cut, len(batch)]):
            key = tuple(keys[:, a])
            if key != held_key:
                held_key, held = key, []
            if kind[a] == 0:
                held.append((ids[a:b], x[a:b], norm[a:b], second[a:b]))
            elif held:
                eid, ex, en, es = held[0] if len(held) == 1 else (np.concatenate(c) for c in zip(*held))
                held = [(eid, ex, en, es)]
                bits = np.frombuffer(b"".join(batch.column(8).slice(a, b - a).to_pylist()), np.uint8).reshape(b - a, -1)
                score = np.einsum("qd,ed->qe", x[a:b], ex) / (norm[a:b, None] * en[None, :])
                score[(np.unpackbits(bits, axis=1)[:, es] == 0) | (ids[a:b, None] == eid[None, :])] = -np.inf
                least = np.partition(score, -top, axis=1)[:, -top] if len(eid) > top else np.full(b - a, -2.0)
                q, e = np.nonzero((score >= least[:, None]) & (score > -np.inf))
                out.append((ids[a:b][q], eid[e], score[q, e]))
        if out:
            yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*out)], names=["query_id", "id", "score"])


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, vector, norm): rows that take part, equal rows once."""
    # 4-byte components stay so: they are exact, and travel with every cell a query visits
    kind = "array<float>" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    base = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(kind).alias("vector"))
    good = base.filter(F.col("id").isNotNull() & F.col("vector").isNotNull()) \
        .filter(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))) \
        .filter(F.exists("vector", lambda x: x != 0))
    return good.distinct().withColumn("norm", F.sqrt(F.aggregate(
        "vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))))


def search(vectors: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", top: int = TOP,
           candidates: int | None = None, sample: int = SAMPLE, codewords: int | None = None,
           recall: float = RECALL) -> DataFrame:
    """(query_id, rank, id, score): each query's ``top`` nearest found, ranks from 1.

    Queries are the rows of ``vectors`` for which the condition ``is_query``
    (over ``id``) holds; candidates all rows with another id and a vector of
    the same length, as a cosine needs (each length has an index of its own).
    score is the cosine of the original vectors, ties go to the smaller id; with
    fewer candidates all are returned. Rows with a null id and vectors that are
    null, zero or hold null or non-finite components take no part; equal rows
    count once. An empty table gives no rows. Only the two named columns are
    read. ``codewords`` per half: sqrt(rows) / 3 by default, between 8 and 512,
    so cell counts are bounded. ``candidates``, the entries a query sees, are by
    default as many as a sample of the queries needs to find ``recall`` of its
    exact neighbours, measured in every table.
    """
    good = write_table(usable(vectors, id_col, vector_col), "vectors")
    out = good.sparkSession.createDataFrame([], "query_id long, rank int, id long, score double")
    for dim, rows in good.groupBy(F.size("vector").alias("d")).count().orderBy("d").collect():   # a row per length
        out = out.unionByName(_search(good.filter(F.size("vector") == dim), is_query, dim, rows, top, candidates,
                                      sample, codewords, recall))
    return out


def _search(good: DataFrame, is_query, dim: int, rows: int, top: int, candidates: int | None, sample: int,
            codewords: int | None, recall: float) -> DataFrame:
    """``search`` among usable vectors of one length."""
    k = codewords or int(min(512, max(8, rows ** 0.5 / 3)))
    some = np.array([r[0] for r in good.select("vector", F.xxhash64("vector").alias("h"))
                     .orderBy("h").limit(sample).select("vector").collect()])
    some = some / np.abs(some).max(1, keepdims=True)
    some /= np.sqrt((some * some).sum(1))[:, None]
    one, two = _halves(some, dim)
    book1, book2 = codebook(one, k), codebook(two, k)

    kind = good.schema["vector"].dataType.simpleString()
    index = map_arrow(good, lambda it: _assigned(it, dim, book1, book2),
                      f"id long, vector {kind}, norm double, cell long")
    # more than top + 1 rows with one vector can't appear in a result: the smallest ids win their ties
    same = Window.partitionBy("cell", F.xxhash64("vector"), F.xxhash64(F.reverse("vector"))).orderBy("id")
    index = write_table(index.withColumn("copy", F.row_number().over(same)).filter(F.col("copy") <= top + 1)
                        .drop("copy"), "index")
    counts = np.zeros(len(book1) * len(book2), np.int64)
    for cell, n in index.groupBy("cell").count().collect():          # at most codewords ** 2 rows
        counts[cell] = n
    queries = good.filter(is_query)
    if candidates is None:
        candidates = enough_for(index, queries, dim, book1, book2, counts, top, recall)
    candidates = max(candidates, top + 1)                             # the query itself may be one of them
    visits = write_table(map_arrow(queries, lambda it: _visits(it, dim, book1, book2, counts, candidates),
                                   "id long, first int, seconds binary"), "visits")
    index = index.withColumn("first", F.expr(f"cast(cell div {len(book2)} as int)")) \
        .withColumn("second", F.expr(f"cast(cell % {len(book2)} as int)"))
    blocks = lambda n: F.ceil(F.count("*") / BLOCK).cast("int").alias(n)
    # a row per first codeword
    sizes = F.broadcast(index.groupBy("first").agg(blocks("entries"))
                        .join(visits.groupBy("first").agg(blocks("visitors")), "first"))
    part = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    here = index.join(sizes, "first").select(
        "first", part("entries").alias("e"), every("visitors").alias("q"), F.lit(0).alias("kind"), "id", "vector", "norm",
        "second", F.lit(None).cast("binary").alias("seconds"))
    come = visits.join(queries, "id").join(sizes, "first").select(
        "first", every("entries").alias("e"), part("visitors").alias("q"), F.lit(1).alias("kind"), "id", "vector", "norm",
        F.lit(-1).alias("second"), "seconds")
    met = here.unionByName(come).repartition("first", "e", "q").sortWithinPartitions("first", "e", "q", "kind")
    scored = map_arrow(met, lambda it: _reranked(it, dim, top), "query_id long, id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top) \
        .select("query_id", "rank", "id", "score")
