import os
import random
import re

import corpus_pipeline
import pytest

from calyx.llm import queries
from calyx.session import scratch_path

SF = "/root/testdata/sf0.001"


def grams(text, k):
    w = text.split()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


@pytest.fixture(scope="module")
def folder(spark, doc_frame, prose):
    """A small corpus with junk, abuse, copies, boilerplate and benchmark passages, as a scale-factor folder."""
    r, docs, kind = random.Random(11), [], {}

    def add(text, what):
        kind[len(docs)] = what
        docs.append((len(docs), text))
    items = [prose(20, 5000 + i) for i in range(5)]
    notice = "Sign up for our weekly news and never miss a thing again"
    for i in range(150):
        lines = [prose(25, 10 * i + k) for k in range(4)]
        if i % 3 == 0:
            lines.insert(r.randint(1, 3), notice)
        add("\n".join(lines), "clean")
    for i in range(0, 60, 2):
        add(docs[i][1], "copy")
        add(docs[i][1].replace(notice, "").strip() + " added", "near")
    for i in range(20):
        add(prose(40, 9000 + i) + " " + items[i % 5] + " " + prose(40, 9500 + i), "leak")
        add(prose(60, 9800 + i).upper().replace(" ", "!! "), "junk")
        add(prose(60, 9900 + i) + " moron scumbag " + prose(9, i) + " moron", "abuse")
    docs += [(1000, None), (1001, ""), (None, prose(60, 77))]
    path = scratch_path(spark, "corpus")
    doc_frame(docs).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(k != "junk"), int(k == "abuse")) for i, k in kind.items()],
                          "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, docs, kind


def test_stages_take_effect(spark, folder):
    path, docs, kind = folder
    frame = spark.read.parquet(f"{path}/documents.parquet")
    columns, after = frame.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        frame = corpus_pipeline.write_table(stage(spark, frame, path), name)
        after[name] = frame.collect()
        assert name == "best_fit_packing" or frame.columns == columns
    ids = {name: {x["doc_id"] for x in rows} for name, rows in after.items()}
    of = lambda *k: {i for i, x in kind.items() if x in k}
    assert not ids["quality_classifier"] & (of("junk", "abuse") | {1000, 1001})
    assert of("clean", "copy", "near", "leak") | {None} <= ids["quality_classifier"]
    notice = [x["doc_id"] for x in after["line_dedup"] if "weekly news" in x["text"]]
    assert notice == [0]
    assert all(x["n_chars"] == len(x["text"]) for x in after["line_dedup"])
    before = {x["doc_id"]: x["text"] for x in after["line_dedup"] if x["doc_id"] is not None}
    kept = {i: t for i, t in before.items() if i in ids["minhash_near_dedup"]}
    for i, t in before.items():                                          # brute force over this stage's own input
        links = [j for j in before if j != i and grams(t, 5) and
                 len(grams(t, 5) & grams(before[j], 5)) >= 0.8 * len(grams(t, 5) | grams(before[j], 5))]
        assert (i in kept) == (not links or i < min(links)) or i not in kept
        if i not in kept:
            assert any(j in kept or j < i for j in links)
    assert of("clean") - ids["line_dedup"] == set() and of("clean") <= ids["minhash_near_dedup"]
    assert not ids["benchmark_decontamination"] & of("leak") and of("clean") <= ids["benchmark_decontamination"]
    assert ids["best_fit_packing"] == ids["benchmark_decontamination"]
    final = corpus_pipeline.run(spark, path)
    assert {x["doc_id"] for x in final.collect()} == ids["best_fit_packing"]


def test_empty_corpus(spark, folder, doc_frame):
    path, frame = folder[0], doc_frame([])
    for name, stage in corpus_pipeline.STAGES:
        frame = corpus_pipeline.write_table(stage(spark, frame, path), name)
        assert frame.count() == 0


def test_every_dealt_operator_has_its_query():
    numbers = sorted(int(re.match(r"op(\d+)_", k)[1]) for k in queries.QUERIES)
    assert numbers == list(range(1, 14))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    for table in ("pages", "documents", "conversations"):
        con.execute(f"create view {table} as select * from read_parquet('{SF}/{table}.parquet')")
    want = con.execute(queries.ORACLES[name]).fetchall()
    names = [d[0] for d in con.description]
    got = [tuple(r) for r in queries.QUERIES[name](spark, SF).select(*names).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
