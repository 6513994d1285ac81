import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from calyx.llm import decontam, langid, linededup, packing, quality


# -------------------------------------------------------------------- packing
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(packing.tokenizer_path())


def test_pieces_and_packing(doc_frame, prose):
    docs = [(i, prose(random.Random(i).randint(1, 900), i)) for i in range(120)]
    docs += [(500, None), (501, ""), (502, prose(9000, 1)), (503, "It's É, ß. ... 12.5 <|endoftext|> ΑΣ x,, y"),
             (None, "a null id"), (504, "again again"), (504, "again again")]
    rows = packing.pack(doc_frame(docs)).collect()
    tok, want = tokenizer(), []
    for i, t in docs:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        want += [(i, p, a, len(ids[a:a + 4096]), zlib.crc32(ids[a:a + 4096].tobytes()))
                 for p, a in enumerate(range(0, len(ids), 4096))]
    key = lambda r: (r[0] is None, r)
    assert sorted((tuple(r[:5]) for r in rows), key=lambda r: (r[0] or -1, *r[1:])) == \
        sorted(want, key=lambda r: (r[0] or -1, *r[1:]))
    seqs = {}
    for r in rows:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in seqs.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(seqs) <= -(-sum(r[3] for r in want) // 4096) + 1
    assert packing.pack(doc_frame([])).count() == 0


def test_plan_is_best_fit_over_counts():
    r = random.Random(1)
    for _ in range(50):
        counts = {r.randint(1, 100): r.randint(1, 60) for _ in range(r.randint(1, 30))}
        fill, seen = {}, {k: [] for k in counts}
        for length, lo, n, first, per, place in packing.plan(counts, 100):
            for k in range(n):
                fill.setdefault(first + k // per, []).append((place + k % per * length, length))
            seen[length] += range(lo, lo + n)
        assert all(sorted(seen[k]) == list(range(n)) for k, n in counts.items())
        for items in fill.values():
            at = 0
            for offset, length in sorted(items):
                assert offset == at
                at += length
            assert at <= 100
        rooms, used = [], 0                                    # best fit decreasing, one piece at a time
        for length in sorted((k for k, n in counts.items() for _ in range(n)), reverse=True):
            fits = [x for x in rooms if x >= length]
            if fits:
                rooms.remove(min(fits))
                rooms.append(min(fits) - length)
            else:
                used += 1
                rooms.append(100 - length)
        assert len(fill) == used


# ----------------------------------------------------------- language identity
def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = langid.Network(["a", "b", "c"], hidden=3)
    x, y = rng.integers(0, 256, (5, 4)).astype(np.uint8), np.array([0, 2, 1, 1])
    for p in net.parameters():
        p += 0  # float32 parameters, checked with wide steps
    _, grads = net.gradients(x, y)
    for p, g in zip(net.parameters(), grads):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        keep, eps = p[at], np.float32(1e-2)
        p[at] = keep + eps
        up, _ = net.gradients(x, y)
        p[at] = keep - eps
        down, _ = net.gradients(x, y)
        p[at] = keep
        assert abs((up - down) / (2 * eps) - g[at]) < 0.03 * abs(g[at]) + 1e-4


def test_languages(doc_frame):
    words = {"en": "the of and that with from this was are have", "de": "der die und nicht mit auf ist ein von schön",
             "fr": "le les des est dans pour que avec été où"}
    r, docs = random.Random(3), []
    for i in range(240):
        lang = r.choice(list(words))
        docs.append((i, " ".join(r.choice(words[lang].split()) for _ in range(r.randint(3, 60))), lang))
    docs += [(900, None, "en"), (901, "", "en"), (902, "123 --- 456", "en"), (903, "the and of " * 20_000, "en"),
             (904, "und die nicht der", None), (None, "que les des avec", "fr"), (905, "the of", "en"), (905, "the of", "en")]
    rows = langid.identify(doc_frame(docs)).collect()
    assert len(rows) == len(docs)
    got = {x["id"]: x for x in rows}
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, *_ in docs if i is not None)
    held = [(got[i]["lang_pred"], lang) for i, _, lang in docs[:240] if got[i]["held_out"]]
    assert len(held) > 30 and sum(a == b for a, b in held) >= 0.95 * len(held)
    assert all((got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0) for i in (900, 901, 902))
    assert got[903]["lang_pred"] == "en" and got[904]["lang_pred"] == "de" and got[None]["lang_pred"] == "fr"
    assert all(0 <= x["score"] <= 1 for x in rows)
    assert langid.identify(doc_frame([])).count() == 0
    alone = langid.identify(doc_frame([(1, "no label here", None)])).collect()
    assert [(x["lang_pred"], x["score"]) for x in alone] == [("und", 0.0)]


# ------------------------------------------------------------- decontamination
def items_frame(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "1 as id", "'x' as word")


def edit_distance_inside(item, text):
    """Least word edits between the item and any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, v in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (v != w)))
        row = new
    return min(row)


def test_passages_match_brute_force(spark, doc_frame, prose):
    r = random.Random(8)
    items = [(i, prose(r.choice([2, 4, 8, 15, 30, 55]), 1000 + i)) for i in range(25)]
    docs = []
    for d in range(160):
        words = prose(r.randint(5, 200), d).split()
        for _ in range(r.choice([0, 1, 1, 2])):
            body = r.choice(items)[1].split()
            for _ in range(int(len(body) * r.choice([0, 0, 0.1, 0.18, 0.3]))):
                k = r.randrange(len(body))
                body[k:k + 1] = r.choice([[], ["zz"], [body[k], "qq"]]) or body[k:k]
            at = r.randint(0, len(words))
            words[at:at] = body
        docs.append((d, " ".join(words)))
    want = {(d, i) for d, t in docs for i, item in items
            if edit_distance_inside(item.split(), t.split()) <= decontam.allowed_edits(len(item.split()))}
    exact = {(d, i) for d, t in docs for i, item in items if f" {item} " in f" {t} "}
    got = decontam.contaminated(doc_frame(docs), items_frame(spark, items)).collect()
    found = {(x["id"], x["item_id"]) for x in got}
    assert exact <= found <= want and len(found) >= 0.99 * len(want) and len(want) > len(exact) > 20
    texts, bodies = dict(docs), dict(items)
    for x in got:
        item = bodies[x["item_id"]].split()
        assert x["distance"] == edit_distance_inside(item, texts[x["id"]].split())
        stretch = texts[x["id"]].split()[x["start_word"]:x["end_word"]]
        assert edit_distance_inside(item, stretch) == x["distance"]


def recall(n, trials, prose):
    """Share of items of ``n`` words found in texts that hold them with all edits allowed."""
    r = random.Random(n)
    vocabulary = prose(4000, 1).split()
    items = [(i, r.choices(vocabulary, k=n)) for i in range(trials)]
    bench = decontam.Benchmark([(i, " ".join(w)) for i, w in items], decontam.SIMILARITY)
    pending = decontam.Pending(bench)
    for i, w in items:
        body = list(w)
        for _ in range(decontam.allowed_edits(n)):
            k = r.randrange(len(body))
            body[k:k + 1] = r.choice([[], [r.choice(vocabulary)], [body[k], r.choice(vocabulary)]])
        text = " ".join(r.choices(vocabulary, k=40) + body + r.choices(vocabulary, k=40))
        raw = np.frombuffer(text.encode(), np.uint8)
        h, _, _, first = decontam.words(raw, np.array([0, len(raw)]), decontam.ALNUM)
        pending.add(pa.array([i]), h, first)
    found = {(i, bench.ids[item]) for i, item, *_ in pending.matches()}
    return sum((i, i) in found for i, _ in items) / trials


def test_recall_at_all_allowed_edits(prose):
    got = {n: recall(n, 200 if n < 200 else 40, prose) for n in (5, 6, 8, 10, 12, 16, 24, 25, 38, 47, 59, 100, 200, 600)}
    print(got)
    assert min(got.values()) >= 0.99


def test_edits_gathered_in_one_place(prose):
    """All edits in the first or the last fifth, as many as are allowed."""
    for n in (30, 50, 100):
        item = prose(n, n).split()
        for at in (0, n - n // 5):
            body = item[:at] + prose(n // 5, 7 * n + at).split() + item[at + n // 5:]
            pending = decontam.Pending(decontam.Benchmark([(1, " ".join(item))], decontam.SIMILARITY))
            raw = np.frombuffer(" ".join([prose(30, 1), *body, prose(30, 2)]).encode(), np.uint8)
            h, _, _, first = decontam.words(raw, np.array([0, len(raw)]), decontam.ALNUM)
            pending.add(pa.array([9]), h, first)
            (found,) = pending.matches()
            assert found[:2] == (9, 0) and found[2] <= n // 5


def test_decontamination_edges(spark, doc_frame, prose):
    passage = prose(20, 5)
    items = [(1, passage), (2, None), (3, ""), (4, "--- !!!"), (5, passage), (None, passage)]
    docs = [(1, None), (2, ""), (3, prose(50_000, 9) + "\n" + passage.upper() + "!"), (4, passage), (4, passage),
            (None, passage), (5, " ".join(passage.split()[:10]))]
    got = sorted(((x["id"], x["item_id"]) for x in
                  decontam.contaminated(doc_frame(docs), items_frame(spark, items)).collect()), key=str)
    assert got == sorted([(d, i) for d in (3, 4, 4, None) for i in (1, 5, None)], key=str)
    blocks = decontam.contaminated(doc_frame(docs), items_frame(spark, items), block_words=25).collect()
    assert sorted(((x["id"], x["item_id"]) for x in blocks), key=str) == got
    assert decontam.contaminated(doc_frame([]), items_frame(spark, items)).count() == 0
    assert decontam.contaminated(doc_frame(docs), items_frame(spark, [])).count() == 0


# ------------------------------------------------------------------ line dedup
def test_recurring_lines_go_but_once(doc_frame, prose):
    docs, r = [], random.Random(2)
    for i in range(40):
        lines = [prose(12, 100 * i + k) for k in range(4)]
        if i % 2:
            lines.insert(2, "Visit our site today for more news")
        if i % 3 == 0:
            lines.insert(1, f"Page {r.randint(1, 999)} of {r.randint(1, 99)} in total")
        if i % 4 == 0:
            lines.append(f"Posted by the user {prose(1, i)}x{'abcdefghij'[i % 10]} on our board")
        docs.append((i, "\n".join(lines)))
    docs += [(100 + i, docs[0][1]) for i in range(30)]                  # whole copies are left to document dedup
    gone = {}
    for x in linededup.recurring_lines(doc_frame(docs)).collect():
        gone.setdefault(x["id"], set()).add(x["line"])
    for i, t in docs[:40]:
        marks = ("Visit our site", "Page ", "Posted by")
        want = {k for k, line in enumerate(t.split("\n"))
                if line.startswith(marks) and not any(
                    i == first and line.startswith(m) for m, first in zip(marks, (1, 0, 0)))}
        assert gone.get(i, set()) == want, i


def test_line_dedup_edges(doc_frame, prose):
    same = "this very line is in every text"
    docs = [(i, f"{prose(8, i)}\n{same}\n{prose(9, 50 + i)}") for i in range(20)]
    docs += [(100, None), (101, ""), (102, same), (103, f"{prose(4, 7)}\r\n\n{same}\n"), (None, f"a b c\n{same}"),
             (104, docs[5][1]), (104, docs[5][1]), (105, "\n".join(prose(6, 900 + k) for k in range(20_000)))]
    frame = doc_frame(docs)
    rows = linededup.line_report(frame).collect()
    assert len(rows) == len(docs)
    got = {x["id"]: (x["n_lines"], x["n_dropped"], x["dropped"]) for x in rows}
    assert got[0] == (3, 0, "") and all(got[i] == (3, 1, "1") for i in [*range(1, 20), 104])
    assert got[100] == (0, 0, "") and got[101] == (1, 0, "") and got[102] == (1, 1, "0")
    assert got[103] == (4, 1, "2") and got[None] == (2, 0, "") and got[105][1] == 0
    kept = linededup.drop_recurring_lines(frame)
    assert kept.columns == frame.columns
    left = {x["doc_id"]: x["text"] for x in kept.collect()}
    assert 102 not in left and left[100] is None and left[101] == "" and left[0] == docs[0][1]
    assert left[3] == "\n".join([docs[3][1].split("\n")[0], docs[3][1].split("\n")[2]])
    assert kept.count() == len(docs) - 1
    assert linededup.line_report(doc_frame([])).count() == 0


def test_blocks_of_lines_go_whole(doc_frame, prose):
    docs, want = [], {}
    for size in (2, 3, 4, 5):
        for at in (0, 3, 6):                                            # start, middle and end of six lines
            block = [prose(7, 70_000 + 100 * size + 10 * at + k) for k in range(size)]
            for c in range(8):
                i = len(docs)
                lines = [prose(11, 100 * i + k) for k in range(6)]
                docs.append((i, "\n".join(lines[:at] + block + lines[at:])))
                if c:
                    want[i] = set(range(at, at + size))
    near = [prose(9, 80_000 + k) for k in range(12)]                    # near copies are left to document dedup
    docs += [(1000 + i, "\n".join([*near, prose(3, 90_000 + i)])) for i in range(9)]
    gone = {}
    for x in linededup.recurring_lines(doc_frame(docs)).collect():
        gone.setdefault(x["id"], set()).add(x["line"])
    assert gone == want


def test_long_lines_go_from_two_documents(doc_frame, prose):
    passage, short = prose(55, 1), prose(8, 2)
    mixed = " ".join(w if k % 10 else "{}" for k, w in enumerate(prose(40, 3).split(), 1))
    docs = [(i, "\n".join(prose(30, 100 * i + k) for k in range(5))) for i in range(10)]
    for i, line in ((1, passage), (4, passage), (2, short), (3, short), (5, short), (6, short), (8, short),
                    (7, mixed.format(*"abcd")), (9, mixed.format(*"efgh"))):
        docs[i] = (i, docs[i][1] + "\n" + line)
    docs += [(20, docs[0][1]), (21, docs[0][1] + " more")]             # copies are left to document dedup
    got = {(x["id"], x["line"]) for x in linededup.recurring_lines(doc_frame(docs)).collect()}
    assert got == {(4, 5), (9, 5)}


# ------------------------------------------------------------------- quality
@pytest.fixture(scope="module")
def corpus(prose):
    """Good prose, four kinds of junk, and prose with abusive words; labels for half of it."""
    r, docs, truth = random.Random(9), [], {}
    for i in range(1200):
        text, kind = prose(r.randint(30, 200), i), r.choice(["good"] * 6 + ["junk"] * 2 + ["abuse"] * 2)
        if kind == "junk":
            how = r.randrange(4)
            words = text.split()
            text = (text.upper().replace(" ", "!! ") if how == 0 else " | ".join(words) if how == 1 else
                    " ".join(words[0] for _ in words) if how == 2 else " ".join(w + r.choice(["###", "$$$"]) for w in words))
        elif kind == "abuse":
            words = text.split()
            for w in r.sample(["moron", "scumbag", "lowlifes", "idiotic"], 3):
                words.insert(r.randrange(len(words)), w + r.choice(["", ".", "ly"]))
            text = " ".join(words)
        docs.append((i, text))
        truth[i] = kind
    return docs, truth


def test_quality_decisions(spark, doc_frame, corpus, prose):
    docs, truth = corpus
    labels = spark.createDataFrame([(i, int(k != "junk"), int(k == "abuse")) for i, k in truth.items() if i % 2],
                                   "doc_id long, quality int, toxic int")
    extra = [(5000, None), (5001, ""), (5002, " \n "), (None, prose(50, 1)), (5003, prose(20_000, 2)),
             (5004, prose(5, 3)), (5005, docs[0][1]), (5005, docs[0][1])]
    rows = quality.classify(doc_frame(docs + extra), labels).collect()
    assert len(rows) == len(docs) + len(extra)
    got = {x["id"]: x for x in rows}
    right = sum(got[i]["kept"] == (k == "good") for i, k in truth.items() if i % 2 == 0)
    assert right >= 0.98 * len(docs) / 2
    assert all(got[i]["kept"] for i, k in truth.items() if k == "good")
    assert not any(got[i]["kept"] for i in (5000, 5001, 5002)) and got[5000]["quality"] == 0
    assert got[None]["kept"] and got[5003]["kept"] and got[5004]["kept"]


def test_quality_edges(spark, doc_frame, prose):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.classify(doc_frame([]), none).count() == 0
    rows = quality.classify(doc_frame([(i, prose(40, i)) for i in range(20)]), none).collect()
    assert all(x["kept"] and x["abuse"] < 0.5 for x in rows)
    assert [x["kept"] for x in quality.classify(doc_frame([(1, None), (2, "")]), none).collect()] == [False, False]


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(1)
    y = rng.random(20_000) < 0.3
    right = np.array([0.95, 0.9, 0.8, 0.7, 0.6])
    votes = np.where(rng.random((20_000, 5)) < right, y[:, None], ~y[:, None]).astype(np.int64)
    votes[rng.random(votes.shape) < 0.2] = quality.SILENT
    pattern, n = np.unique(votes, axis=0, return_counts=True)
    model = quality.LabelModel(pattern, n.astype(float))
    assert np.abs(model.accuracy() - right).max() < 0.05 and abs(model.prior - 0.3) < 0.05
