import random
import zlib

import numpy as np

from calyx.llm import slackpack


def places(rows):
    """sequence -> sorted (offset, length) of plan rows, and (length, rank) -> sorted (start, size)."""
    fill, cover = {}, {}
    for length, lo, n, start, size, first, per, place, base, _ in rows:
        for i in range(n):
            k = base + i
            fill.setdefault(first + k // per, []).append((place + k % per * size, size))
            cover.setdefault((length, lo + i), []).append((start, size))
    return fill, cover


def gapless(parts):
    at = 0
    for start, size in sorted(parts):
        assert start == at
        at += size
    return at


def test_closest_is_the_best_sum():
    for seed in range(200):
        r = random.Random(seed)
        counts = {r.randint(1, 90): r.randint(1, 20) for _ in range(r.randint(1, 12))}
        target = r.randint(0, 100)
        use, reach = slackpack.closest(counts, target), {0}
        for k, n in counts.items():
            for _ in range(min(n, target // k)):
                reach |= {x + k for x in reach if x + k <= target}
        assert sum(k * u for k, u in use.items()) == max(reach)
        assert all(0 < u <= counts[k] for k, u in use.items())


def test_plan_places_all_and_pads_nothing():
    for seed in range(150):
        r = random.Random(seed)
        cap = r.choice([16, 100, 256])
        counts = {r.randint(1, cap - 1): r.randint(1, r.choice([1, 5, 50])) for _ in range(r.randint(1, 25))}
        plan = slackpack.Plan(counts, cap)
        fill, cover = places(plan.rows)
        assert set(cover) == {(k, i) for k, n in counts.items() for i in range(n)}
        assert all(gapless(parts) == k for (k, _), parts in cover.items())
        totals = [gapless(parts) for parts in fill.values()]
        last = [t for t in totals if t != cap]
        assert len(set(last)) == len(last) and all(t & (t - 1) == 0 for t in last)
        assert sorted(fill) == list(range(plan.sequences))


def test_many_lengths_are_rarely_cut():
    r, counts = random.Random(2), {}
    for _ in range(100_000):
        k = int(r.lognormvariate(6, 1.2)) % 2047 or 1
        counts[k] = counts.get(k, 0) + 1
    plan = slackpack.Plan(counts, 2048)
    assert sum(row[2] for row in plan.rows if row[9]) < 2000 and len(plan.rows) < 30_000


def tokens(docs):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(slackpack.tokenizer_path())
    return [np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for _, t in docs]


def check(docs, rows, capacity=2048):
    """Each document's pieces are its ids, in place; each sequence is full or a different power of two."""
    left, seqs = {}, {}
    for (i, _), ids in zip(docs, tokens(docs)):
        left.setdefault((i, len(ids)), []).append(ids)
    pieces = {}
    for r in rows:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        pieces.setdefault((r["id"], r["doc_tokens"]), []).append((r["start"], r["length"], r["ids_crc32"]))
    assert set(pieces) == set(left)
    for key, found in pieces.items():
        copies = left[key]
        assert sum(p[1] for p in found) == key[1] * len(copies)
        if len(copies) == 1:
            assert gapless([p[:2] for p in found]) == key[1]
        for start, n, crc in found:
            assert crc in {zlib.crc32(ids[start:start + n].tobytes()) for ids in copies}
    totals = [gapless(parts) for parts in seqs.values()]
    last = [t for t in totals if t != capacity]
    assert len(set(last)) == len(last) and all(t & (t - 1) == 0 for t in last)
    return totals


def test_pack(doc_frame, prose):
    docs = [(i, prose(random.Random(i).randint(1, 900), i)) for i in range(100)]
    docs += [(500, None), (501, ""), (502, prose(9000, 1)), (504, "again again"), (504, "again again"),
             (503, "It's É,\t ß.\n\n  ... 12.5 <|endoftext|> ΑΣ漢字🙂 x,, y'll"), (None, "a null id"), (505, " " * 5000),
             (506, "a" * 20000), (507, "\r\n" * 3000)]
    rows = slackpack.pack(doc_frame(docs)).collect()
    assert rows[0].__fields__ == ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    check(docs, rows)
    assert slackpack.pack(doc_frame([])).count() == 0


def test_pack_cuts_what_fits_nowhere(doc_frame):
    """Every text has the same length, which no multiple of fits a window."""
    docs = [(i, "the cat " * 700) for i in range(60)]
    rows = slackpack.pack(doc_frame(docs)).collect()
    assert len(rows) > 60
    check(docs, rows)
    docs = [(i % 3, "the cat " * 300) for i in range(50)]           # repeated rows, each packed on its own
    check(docs, slackpack.pack(doc_frame(docs), capacity=512).collect(), 512)
