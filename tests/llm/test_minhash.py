import random
import re

import numpy as np
from pyspark.sql import functions as F

from calyx.llm import common, minhash

LOW = {i: i + 32 for i in range(65, 91)}


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(docs, k, percent):
    sets = {i: shingles(t, k) for i, t in docs}
    part = {i: i for i in sets}

    def find(x):
        while part[x] != x:
            x = part[x]
        return x
    for a in sets:
        for b in sets:
            same = len(sets[a] & sets[b])
            if a < b and same and 100 * same >= percent * (len(sets[a] | sets[b])):
                x, y = sorted((find(a), find(b)))
                part[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def edited(text, share, r):
    w = text.split()
    for _ in range(max(1, int(share * len(w)))):
        i = r.randrange(len(w))
        w[i:i + 1] = r.choice([[], ["new%d" % r.randrange(10**6)], [w[i], "more%d" % r.randrange(10**6)]])
    return " ".join(w)


def test_components_match_brute_force(doc_frame, prose):
    """Groups of copies edited around the threshold, so that stars fail and chains matter."""
    r, docs = random.Random(4), []
    for g in range(12):
        base = prose(r.choice([5, 12, 40, 120]), g)
        for c in range(r.choice([1, 3, 14])):
            docs.append((len(docs) * 3 + 1, base if c == 0 else edited(base, r.choice([0.005, 0.02, 0.04, 0.06]), r)))
    got = {x["id"]: x for x in minhash.near_duplicates(doc_frame(docs), k=4).collect()}
    want = brute(docs, 4, 80)
    assert {i: (x["n_shingles"], x["component_id"]) for i, x in got.items()} == want
    assert all(x["kept"] == (x["component_id"] == i) for i, x in got.items())
    assert any(c != i for i, (_, c) in want.items())


def test_edges(doc_frame, prose):
    long = prose(30_000, 1)
    docs = [(7, None), (8, ""), (9, " \t\n"), (1, "a b"), (2, "A  b"), (3, "b a"), (4, long), (5, long + " x"),
            (6, "a b"), (6, "a b"), (None, "a b"), (10, "é É"), (11, "é É ")]
    rows = minhash.near_duplicates(doc_frame(docs), k=4).collect()
    assert len(rows) == len(docs)
    got = {x["id"]: (x["n_shingles"], x["component_id"], x["kept"]) for x in rows}
    assert got[7] == (0, 7, True) and got[8] == (0, 8, True) and got[9] == (0, 9, True)
    assert got[1] == (1, 1, True) and got[2] == (1, 1, False) and got[6] == (1, 1, False) and got[3] == (1, 3, True)
    assert got[5][1] == 4 and not got[5][2]
    assert got[None] == (1, None, True)
    assert got[10][1] == 10 and got[11][1] == 11                        # only ASCII white space splits
    assert minhash.near_duplicates(doc_frame([])).count() == 0


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    dense = minhash.Densifier(64, 8)
    for n in (6, 60, 2000):
        x = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
        y = np.unique(np.concatenate([x[: int(0.8 * n)], rng.integers(0, 2**63, n // 5, dtype=np.uint64)]))
        true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        same = (dense.signature(x) == dense.signature(y)).mean()
        assert abs(same - true) < 0.2


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(300, 299), (299, 300)]
    got = {r[0]: r[1] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 160))
    assert got[300] == got[299] == 299
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_only_marked_keeps_every_key(spark):
    keys = spark.range(0, 5000, 7).select(F.col("id").alias("k"))
    rows = spark.range(5000)
    got = {r[0] for r in common.only_marked(rows, "id", keys).collect()}
    assert set(range(0, 5000, 7)) <= got and len(got) < 1000


def test_words_and_prefix_hashes():
    texts = ["Ab  cd", "", "é x"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.cumsum([0] + [len(t.encode()) for t in texts])
    h, s, e, first, two = common.words(raw, off, stems=(2,))
    assert list(first) == [0, 2, 2, 4]
    assert h[0] == common.word_hash("ab") and h[1] == common.word_hash("CD") and h[2] == common.word_hash("é")
    assert two[0] == two[0] and len(two) == 4
