import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from calyx.llm import convtrie, scan

SCHEMA = "conv_id long, turn long, role string, text string, c long, pos long, depth long, owner long, a long, n long"


def frame(spark, rows):
    return spark.createDataFrame([r + (None,) * 6 for r in rows], SCHEMA)


def ordered(rows):
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            by[c].append(((turn is not None, turn or 0), tie, role, text))
    return {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in by.items()}


def regrafted(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return out


def brute(convs):
    members, kids, leaves, saved = defaultdict(list), defaultdict(int), defaultdict(int), defaultdict(int)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, m in members.items():
        more = (len(m) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += more
            leaves[node[:d]] += not kids[node]
    out = []
    for node, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(node))
        out.append((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), kids[node], leaves[node],
                    saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[:2])


def random_rows(seed):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(-5, 60), 30):
        for turn in range(r.choice([1, 2, 4, 5, 8, 9, 17])):
            rows.append((c, turn, r.choice(["user", "assistant", None]) if turn % 3 == 2 else "user",
                         r.choice(["a", "b", "", None]) if turn > 1 else r.choice(["hi", "hello"])))
    return rows


@pytest.mark.parametrize("block", [1, 3, 4, 64])
def test_against_brute_force(spark, block):
    rows = random_rows(block)
    assert result(convtrie.prefix_trie(frame(spark, rows), block=block)) == brute(ordered(rows))


def test_regrafted_conversations(spark):
    rows = [r for r in random_rows(9) if r[0] >= 0]
    turns = convtrie.ranked(convtrie.digests(frame(spark, rows)))
    want = brute(regrafted(ordered(rows)))
    assert result(convtrie.trie(*convtrie.regrafted(turns))) == want
    # turnless conversations are members of the root
    rows = [(c, 0, "u", "x") for c in (1, 2, 3, 4, 6, 7)]
    turns = convtrie.ranked(convtrie.digests(frame(spark, rows)))
    want = brute(regrafted(ordered(rows)))
    assert result(convtrie.trie(*convtrie.regrafted(turns))) == want and want[0][3] == 6


def test_nulls_ties_and_repeats(spark):
    rows = [(1, None, "user", "b"), (1, 0, None, "a"), (1, 0, "user", None), (1, 0, "user", None), (2, None, "user", "b"),
            (2, 0, "user", None), (None, 0, "user", "gone"), (3, 5, "ab", "c"), (4, 5, "a", "bc"), (5, 1, "x" * 70000, "")]
    assert result(convtrie.prefix_trie(frame(spark, rows))) == brute(ordered(rows))
    assert convtrie.prefix_trie(frame(spark, [])).count() == 0
    assert convtrie.prefix_trie(frame(spark, [(None, 1, "u", "t")])).count() == 0


def test_hot_groups(spark):
    """A third of the conversations are equal, and one conversation holds a third of the turns."""
    rows = [(c, t, "u", f"same {t}") for c in range(60) for t in range(3)]
    rows += [(c, t, "u", f"{c} {t}" if t else "same 0") for c in range(60, 180) for t in range(2)]
    rows += [(500, t, "u", f"long {t}") for t in range(210)] + [(501, t, "u", f"long {t}") for t in range(205)]
    assert result(convtrie.prefix_trie(frame(spark, rows))) == brute(ordered(rows))


def test_ends_of_a_node_in_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(convtrie, "CHUNK", 7)
    ends = spark.range(100).selectExpr("1L as owner", "2L as depth", "id * 3 as c").repartition(5)
    got = convtrie.ends_digests(ends).collect()
    assert [tuple(r) for r in got] == [(1, 2, hashlib.sha256(",".join(str(3 * i) for i in range(100)).encode()).hexdigest())]


def test_running_sums_cross_ranges(spark):
    r = random.Random(1)
    rows = [(r.choice([7, 7, 7, r.randint(0, 40)]), i, r.randint(0, scan.MASK), 1) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, i long, v long, one long").repartition(6)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(x["k"], x["i"]): (x["before_v"], x["before_one"]) for x in
               scan.running(df, "k", ["i"], ["v", "one"]).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    total = defaultdict(lambda: (0, 0))
    for k, i, v, _ in rows:
        assert got[k, i] == total[k]
        total[k] = (total[k][0] + v) & scan.MASK, total[k][1] + 1
    empty = spark.createDataFrame([], "k long, i long, v long")
    assert scan.running(empty, "k", ["i"], ["v"]).count() == 0
