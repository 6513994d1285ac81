"""Whitening of embeddings by their weighted multiplicity covariance.

Vectors become whole-number vectors x. Equal x are grouped first, so a vector
that a third of the table repeats is one row with a count. Counts (or one) are
the weights of the fit: exact sums, then a centred matrix product per task,
whose d x d partial products Spark adds up. Only such matrices come to the
driver. Each distinct vector is whitened once and joined back to its rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, write_table

COMPONENTS = 8


def whole_vectors(rows: DataFrame, vec_col: str, scale: int = 1024, shift: int = 100000) -> DataFrame:
    """``rows`` with x, the long vector floor(scale * c) + shift; rows without a usable vector are left out.

    Not usable: a null or empty vector, one with a null or non-finite entry, or
    one whose scaled entry doesn't fit a long (beyond 2**62).
    """
    v = F.transform(F.col(vec_col), lambda c: c.cast("double") * F.lit(float(scale)))
    good = F.forall(v, lambda c: c.isNotNull() & (F.abs(c) < F.lit(2.0**62)))     # NaN and infinities are larger
    return rows.filter(F.coalesce((F.size(vec_col) > 0) & good, F.lit(False))) \
        .withColumn("x", F.transform(v, lambda c: F.floor(c) + F.lit(shift)))


def _by_dim(batches) -> Iterator[tuple[int, np.ndarray, np.ndarray, pa.RecordBatch]]:
    """(dim, matrix, weights, rows) for each dim of each batch; columns dim, v (lists of one length a dim) and w."""
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for d in np.unique(dims):
            some = batch if (dims == d).all() else batch.filter(pa.array(dims == d))
            flat = some.column("v").flatten().to_numpy(zero_copy_only=False)
            yield int(d), flat.reshape(some.num_rows, -1), some.column("w").to_numpy(), some


def _sums(batches) -> Iterator[pa.RecordBatch]:
    n: dict[int, int] = {}
    total: dict[int, np.ndarray] = {}
    for d, x, w, _ in _by_dim(batches):
        if x.dtype == np.int64:
            small = float(np.abs(x.astype(float)).max()) * float(w.sum()) < 2.0**62
            s = (x * w[:, None] if small else x.astype(object) * w.astype(object)[:, None]).sum(0).astype(object)
        else:
            s = (x * w[:, None]).sum(0)
        n[d] = n.get(d, 0) + int(w.sum())
        total[d] = total[d] + s if d in total else s
    for d, s in total.items():
        whole = s.dtype == object
        k = len(s)
        yield pa.record_batch([pa.array([d] * k, pa.int32()), pa.array(range(k), pa.int32()), pa.array([n[d]] * k),
                               pa.array([Decimal(int(a)) if whole else None for a in s], pa.decimal128(38, 0)),
                               pa.array([None if whole else float(a) for a in s], pa.float64())],
                              names=["dim", "i", "n", "whole", "real"])


class Fit:
    """n, centre and covariance of the vectors of one length.

    The centre is a whole part and a rest below one, so that x less its whole
    part is exact.
    """

    def __init__(self, n: int, sums: list):
        self.n = n
        if isinstance(sums[0], int):
            self.whole = [s // n for s in sums]
            self.left = [s - n * a for s, a in zip(sums, self.whole)]
            self.rest = np.array([r / n for r in self.left])
        else:
            self.whole, self.rest = None, np.array(sums) / n
        self.cov = np.zeros((len(sums), len(sums)))

    def offsets(self, x: np.ndarray) -> np.ndarray:
        """x less the whole part of the centre, exactly."""
        if max(map(abs, self.whole)) < 2**61 and np.abs(x.astype(float)).max(initial=0) < 2.0**61:
            return x - np.array(self.whole, np.int64)
        return x.astype(object) - np.array(self.whole, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x if self.whole is None else self.offsets(x).astype(float)) - self.rest

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n*x - S)**2 per row, exact."""
        t = self.offsets(x)
        most = self.n * (float(np.abs(t.astype(float)).max(initial=0)) + 1)
        if t.dtype == np.int64 and most * most * t.shape[1] < 2.0**62:
            return ((self.n * t - np.array(self.left, np.int64)) ** 2).sum(1).tolist()
        t = self.n * t.astype(object) - np.array(self.left, object)
        return (t * t).sum(1).tolist()


def _products(batches, fits: dict[int, Fit]) -> Iterator[pa.RecordBatch]:
    g: dict[int, np.ndarray] = {}
    for d, x, w, _ in _by_dim(batches):
        c = fits[d].centred(x)
        p = (c * w[:, None]).T @ c
        g[d] = g[d] + p if d in g else p
    for d, m in g.items():
        yield pa.record_batch([pa.array([d] * len(m), pa.int32()), pa.array(range(len(m)), pa.int32()),
                               pa.array(list(m), pa.list_(pa.float64()))], names=["dim", "i", "row"])


def _added(table: pa.Table) -> pa.Table:
    rows = np.stack([r.as_py() for r in table.column("row")])
    return pa.table({"dim": table.column("dim")[:1], "i": table.column("i")[:1],
                     "row": pa.array([rows.sum(0)], pa.list_(pa.float64()))})


def covariances(base: DataFrame) -> dict[int, Fit]:
    """Per dim the weighted count, centre and covariance (divisor: the count) of rows (dim int, v array, w long).

    Vectors are centred before multiplying, and long ones are summed exactly. A
    task gives k rows of k numbers for each dim of k entries that it meets;
    their sums, k x k numbers, come to the driver.
    """
    parts = map_arrow(base, _sums, "dim int, i int, n long, whole decimal(38,0), real double")
    sums: dict[int, list] = {}
    for r in parts.groupBy("dim", "i").agg(F.sum("n").alias("n"), F.sum("whole").alias("whole"),
                                           F.sum("real").alias("real")).orderBy("dim", "i").collect():
        sums.setdefault(r["dim"], []).append((r["n"], int(r["whole"]) if r["whole"] is not None else r["real"]))
    fits = {d: Fit(rows[0][0], [s for _, s in rows]) for d, rows in sums.items()}
    parts = map_arrow(base, lambda it: _products(it, fits), "dim int, i int, row array<double>")
    for r in parts.groupBy("dim", "i").applyInArrow(_added, "dim int, i int, row array<double>").toLocalIterator():
        fits[r["dim"]].cov[r["i"]] = r["row"]
    for fit in fits.values():
        fit.cov = (fit.cov + fit.cov.T) / (2 * fit.n)
    return fits


def principal(cov: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) by falling eigenvalue; each vector's largest entry is positive."""
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:most], u[:, ::-1][:, :most]
    return e, u * np.sign(u[np.abs(u).argmax(0), np.arange(u.shape[1])])


def _whitened(batches, fits: dict[int, Fit], axes: dict[int, tuple]) -> Iterator[pa.RecordBatch]:
    for d, x, _, some in _by_dim(batches):
        e, u, usable = axes[d]
        y = fits[d].centred(x) @ u / np.sqrt(np.where(usable, e, 1.0))
        k = len(e)
        flat = pa.array(y.ravel(), mask=np.tile(~usable, len(y)))
        listed = pa.ListArray.from_arrays(pa.array(np.arange(0, k * len(y) + 1, k), pa.int32()), flat)
        deviation = pa.array([Decimal(a) if a < 10**38 else None for a in fits[d].deviation(x)],
                             pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([*some.columns, deviation, listed], names=["dim", "v", "w", "deviation", "y"])


def whiten(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", most: int = COMPONENTS,
           weights: str = "counts", scale: int = 1024, shift: int = 100000) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) for each usable row and component.

    The fit list holds every usable row's x (``weights="counts"``) or every
    distinct x once (``"one"``); its size is ``n``. ``deviation`` is a whole
    number, null beyond 38 digits. ``explained`` is the eigenvalue over the trace.
    ``identity_error`` is the largest entry of the whitened rows' covariance
    less the identity.

    Rows whose vector isn't usable (see ``whole_vectors``) are left out; a null
    id and repeated rows stay. Vectors of different lengths are fit lists of
    their own. A vector of fewer than ``most`` entries has as many components
    as entries. A component without variance (a constant dimension, equal
    vectors, fewer vectors than dimensions) has a null ``whitened`` and
    explains 0.0. An empty table gives no rows. Other columns are not read.
    """
    if weights not in ("counts", "one"):
        raise ValueError("weights: counts or one")
    spark = rows.sparkSession
    named = whole_vectors(rows.select(F.col(id_col).alias("id"), F.col(vec_col).alias("c")), "c", scale, shift) \
        .select("id", "x")
    weight = F.count("*") if weights == "counts" else F.max(F.lit(1))
    distinct = write_table(named.groupBy("x").agg(weight.cast("long").alias("w")), "vectors")
    vectors = distinct.select(F.size("x").alias("dim"), F.col("x").alias("v"), "w")
    fits = covariances(vectors)
    axes, trace = {}, {}
    for d, fit in fits.items():
        e, u = principal(fit.cov, most)
        axes[d] = e, u, e > d * np.finfo(float).eps * max(e[0], 0)
        trace[d] = float(np.trace(fit.cov))
    done = write_table(map_arrow(vectors, lambda it: _whitened(it, fits, axes),
                                 "dim int, v array<long>, w long, deviation decimal(38,0), y array<double>"),
                       "whitened")
    checks = covariances(done.select("dim", F.filter("y", lambda a: a.isNotNull()).alias("v"), "w")
                         .filter(F.size("v") > 0))
    facts = []
    for d, fit in fits.items():
        e, _, good = axes[d]
        error = float(np.abs(checks[d].cov - np.eye(len(checks[d].cov))).max()) if d in checks else None
        facts.append((d, fit.n, [float(a) / trace[d] if g else 0.0 for a, g in zip(e, good)], error))
    facts = spark.createDataFrame(facts, "dim int, n long, explained array<double>, identity_error double")
    back = named.join(done.drop("w"), named["x"] == done["v"])
    # a row for each vector length there is
    return back.join(F.broadcast(facts), "dim") \
        .select("id", "n", "deviation", "explained", "identity_error", F.posexplode("y").alias("at", "whitened")) \
        .select("id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened",
                F.get("explained", F.col("at")).alias("explained"), "identity_error")
