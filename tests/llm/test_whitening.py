import random

import numpy as np
import pytest

from calyx.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, id long, x string, n long, component int, y double, dim int, w long"


def frame(spark, rows):
    rows = [(i, v) + (None,) * 7 for i, v in rows]
    return spark.createDataFrame(rows, SCHEMA)


def brute(vectors, most=8):
    """(deviations, whitened columns, explained) of all vectors, one by one."""
    x = [[int(np.floor(1024 * float(np.float32(c)))) + 100000 for c in v] for v in vectors]
    n, total = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, total)) for row in x]
    centred = np.array([[a - s / n for a, s in zip(row, total)] for row in x])
    cov = centred.T @ centred / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:most], u[:, ::-1][:, :most]
    return deviation, centred @ u / np.sqrt(e), e / np.trace(cov)


def check(rows, vectors, ids):
    deviation, want, explained = brute(vectors)
    k = want.shape[1]
    rows = sorted(rows, key=lambda r: (r["id"], r["component"]))
    got = np.array([r["whitened"] for r in rows]).reshape(-1, k)
    order = np.argsort(ids, kind="stable")
    assert [r["id"] for r in rows[::k]] == sorted(ids)
    assert [int(r["deviation"]) for r in rows[::k]] == [deviation[i] for i in order]
    sign = np.sign((want[order] * got).sum(0))
    assert np.abs(got - want[order] * sign).max() < 1e-9
    assert np.allclose([r["explained"] for r in rows[:k]], explained, rtol=1e-9)
    assert {r["n"] for r in rows} == {len(vectors)}
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-9


def test_against_brute_force_with_a_hot_vector(spark):
    r = random.Random(3)
    vectors = [[r.gauss(0, 0.1 * (j + 1)) for j in range(10)] for _ in range(120)]
    vectors += [vectors[0]] * 60                                  # a third of the rows
    rows = whitening.whiten(frame(spark, list(enumerate(vectors)))).collect()
    assert rows[0].__fields__ == ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(rows, vectors, list(range(len(vectors))))


def test_unusable_vectors_are_left_out(spark):
    r = random.Random(4)
    good = [[r.gauss(0, 1), r.gauss(0, 2), r.gauss(0, 3)] for _ in range(30)]
    bad = [None, [], [1.0, None, 2.0], [float("nan"), 1.0, 2.0], [float("inf"), 1.0, 2.0], [-float("inf"), 1.0, 2.0],
           [3e38, 1.0, 2.0]]
    rows = whitening.whiten(frame(spark, list(enumerate(good)) + [(100 + i, v) for i, v in enumerate(bad)])).collect()
    assert {x["component"] for x in rows} == {1, 2, 3}             # fewer entries than components
    check(rows, good, list(range(30)))


def test_repeated_rows_and_null_ids_stay(spark):
    r = random.Random(5)
    vectors = [[r.gauss(0, 1), r.gauss(0, 1)] for _ in range(20)]
    rows = whitening.whiten(frame(spark, [(i % 7 or None, v) for i, v in enumerate(vectors)] * 2)).collect()
    assert len(rows) == 80 and sum(x["id"] is None for x in rows) == 12 and {x["n"] for x in rows} == {40}


def test_lengths_are_fit_apart(spark):
    r = random.Random(6)
    two = [[r.gauss(0, 1), r.gauss(0, 2)] for _ in range(25)]
    four = [[r.gauss(0, j + 1) for j in range(4)] for _ in range(35)]
    rows = whitening.whiten(frame(spark, list(enumerate(two + four)))).collect()
    check([x for x in rows if x["id"] < 25], two, list(range(25)))
    check([x for x in rows if x["id"] >= 25], four, list(range(25, 60)))


def test_no_variance(spark):
    rows = whitening.whiten(frame(spark, [(i, [0.5, 0.25]) for i in range(5)])).collect()
    assert len(rows) == 10 and all(x["whitened"] is None and x["explained"] == 0 and x["identity_error"] is None
                                   and x["deviation"] == 0 for x in rows)
    r = random.Random(7)
    rows = whitening.whiten(frame(spark, [(i, [0.5, r.gauss(0, 1)]) for i in range(9)])).collect()
    first = [x for x in rows if x["component"] == 1]
    assert abs(sum(x["whitened"] ** 2 for x in first) / 9 - 1) < 1e-9 and first[0]["explained"] == 1
    assert all(x["whitened"] is None for x in rows if x["component"] == 2)
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, None)])).count() == 0


def test_weights_of_one(spark):
    r = random.Random(8)
    vectors = [[r.gauss(0, 1), r.gauss(0, 2)] for _ in range(40)]
    rows = whitening.whiten(frame(spark, list(enumerate(vectors + vectors[:1] * 30))), weights="one").collect()
    assert {x["n"] for x in rows} == {40} and len(rows) == 140
    check([x for x in rows if x["id"] < 40], vectors, list(range(40)))
    with pytest.raises(ValueError, match="weights"):
        whitening.whiten(frame(spark, []), weights="both")


def test_large_entries_stay_exact(spark):
    vectors = [[float(2**40 + 5 * i), float(3 * i * i)] for i in range(8)]
    rows = whitening.whiten(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>"))
    x = [[1024 * int(c) + 100000 for c in v] for v in vectors]
    total = [sum(c) for c in zip(*x)]
    want = {i: sum((8 * a - s) ** 2 for a, s in zip(row, total)) for i, row in enumerate(x)}
    assert {r["id"]: int(r["deviation"]) for r in rows.collect()} == want
    far = spark.createDataFrame([(0, [1e15]), (1, [-1e15]), (2, [0.0])], "vec_id long, embedding array<double>")
    assert all(r["deviation"] is not None for r in whitening.whiten(far).collect())
