"""Packing by minimum bin slack, planned over the multiset of remaining lengths.

Texts are tokenised once and only piece lengths travel. What a text has beyond
whole windows is one piece; full windows are sequences already. A window starts
with the longest piece that is left; subset-sum dynamic programming over the
counts of the lengths, with an integer as the set of reachable sums, picks the
multiset that fills the rest closest, and is walked back to counts. It serves
as many windows as the counts allow. Where the closest fill leaves slack, one
more piece per window is cut to fill it, and its rest goes back to the multiset.
The last window, which nothing is left to fill, is cut into powers of two.

The plan depends on the lengths there are (fewer than ``capacity``), not on the
corpus. Pieces look up their places by length and rank; ranks are counted along
sorted ranges, so a length that a third of the corpus shares is ranked by many tasks.
"""

from __future__ import annotations

import json
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, only_marked, write_table
from .packing import byte_letters
from .scan import running

CAPACITY = 2048
END_ID = 1
#: fixed value: how this vocabulary cuts a text before merging
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
OUT_ROWS = 8192


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


_encoders: dict = {}


def encoder(path: str):
    """text -> ids (numpy) by the byte-level vocabulary at ``path``.

    The ids are those of ``tokenizers``; its merges are handed to ``tiktoken``,
    which is several times as fast, and which ranks merges by their result's id.
    """
    if path not in _encoders:
        import tiktoken
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        vocabulary, added = told["model"]["vocab"], {t["content"]: t["id"] for t in told.get("added_tokens", [])}
        made = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in told["model"]["merges"]]
        if any(a >= b for a, b in zip(made, made[1:])):
            raise ValueError("merges don't follow the order of ids")
        letter = {c: b for b, c in enumerate(byte_letters())}
        ranks = {bytes(letter[c] for c in token): i for token, i in vocabulary.items() if token not in added}
        made = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)
        _encoders[path] = lambda text: made.encode_to_numpy(text, allowed_special="all", disallowed_special=())
    return _encoders[path]


def _ids(encode, text: str | None, end_id: int) -> bytes:
    ids = encode(text) if text else np.zeros(0, np.uint32)
    return ids.astype("<u4").tobytes() + end_id.to_bytes(4, "little")


def _texts(column: pa.Array) -> Iterator[str | None]:
    """One text at a time, so that only one is held besides the batch."""
    for t in column:
        yield t.as_py()


def _pieces(batches, path: str, capacity: int, end_id: int) -> Iterator[pa.RecordBatch]:
    encode, names = encoder(path), ["id", "key", "start", "length", "ids_crc32", "doc_tokens"]
    for batch in batches:
        rows: list[tuple] = []
        for doc, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _texts(batch.column(2))):
            body = _ids(encode, text, end_id)
            n = len(body) // 4
            rows += [(doc, key, a, min(capacity, n - a), zlib.crc32(body[4 * a:4 * (a + capacity)]), n)
                     for a in range(0, n, capacity)]
            if len(rows) >= OUT_ROWS:
                yield _batch(rows, names)
                rows = []
        if rows:
            yield _batch(rows, names)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, pa.string() if n == "key" else pa.int64()) for c, n in zip(zip(*rows), names)],
                           names=names)


# ------------------------------------------------------------------- the plan
def closest(counts: dict[int, int], target: int) -> dict[int, int]:
    """How many of each length to take so that their sum comes closest to ``target`` from below.

    ``counts`` bounds them. Lengths enter from the longest on, in runs of 1, 2,
    4 ... copies; bit s of ``sums`` says that the sum s can be reached.
    """
    full, sums, steps = (1 << target + 1) - 1, 1, []
    for length in sorted((k for k in counts if k <= target), reverse=True):
        left, run = min(counts[length], target // length), 1
        while left and not sums >> target:
            run = min(run, left)
            steps.append((length, run, sums))
            sums = (sums | sums << length * run) & full
            left, run = left - run, run * 2
        if sums >> target:
            break
    at, used = sums.bit_length() - 1, {}
    for length, run, before in reversed(steps):
        if not before >> at & 1:
            at -= length * run
            used[length] = used.get(length, 0) + run
    return used


class Plan:
    """Places for pieces of known lengths: ``rows`` of LENGTH, LO, N, START, TAKE, FIRST, PER, PLACE, BASE, LAYER.

    The parts [START, START + TAKE) of the pieces of LENGTH with ranks LO .. LO+N
    go to sequence FIRST + k div PER at PLACE + (k mod PER) * TAKE, where k is
    BASE + rank - LO. The parts of a cut piece are in layers 0, 1, ...
    """

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        self.rows: list[tuple] = []
        self.left = {k: n for k, n in counts.items() if n}
        self.lots = {k: deque([(k, 0, n, 0, 0)]) for k, n in self.left.items()}   # length, lo, n, start, layer
        self.sequences = 0
        while self.left:
            self._windows(capacity)

    def _add(self, length: int, lot: tuple) -> None:
        self.lots.setdefault(length, deque()).append(lot)
        self.left[length] = self.left.get(length, 0) + lot[2]

    def _take(self, length: int, n: int, size: int, first: int, per: int, place: int) -> None:
        """Places the first ``size`` tokens of ``n`` pieces that are ``length`` long now; the rest stays."""
        base, lots = 0, self.lots[length]
        self.left[length] -= n
        while n:
            origin, lo, have, start, layer = lots.popleft()
            m = min(n, have)
            self.rows.append((origin, lo, m, start, size, first, per, place, base, layer))
            if m < have:
                lots.appendleft((origin, lo + m, have - m, start, layer))
            if size < length:
                self._add(length - size, (origin, lo, m, start + size, layer + 1))
            n, base = n - m, base + m
        if not self.left[length]:
            del self.left[length], self.lots[length]

    def _windows(self, capacity: int) -> None:
        longest = max(self.left)
        rest = {k: n - (k == longest) for k, n in self.left.items()}
        use = closest({k: n for k, n in rest.items() if n}, capacity - longest)
        use[longest] = use.get(longest, 0) + 1
        slack = capacity - sum(k * u for k, u in use.items())
        cut = max((k for k, n in self.left.items() if n > use.get(k, 0)), default=0) if slack else 0
        if slack and not cut:                      # all that is left is in this window
            return self._last(use, capacity - slack)
        times = min(self.left[k] // (u + (k == cut)) for k, u in use.items())
        if cut and cut not in use:
            times = min(times, self.left[cut])
        place = 0
        for k in sorted(use, reverse=True):
            self._take(k, use[k] * times, k, self.sequences, use[k], place)
            place += k * use[k]
        if cut:
            self._take(cut, times, slack, self.sequences, 1, place)
        self.sequences += times

    def _last(self, use: dict[int, int], total: int) -> None:
        """The last pieces fill sequences whose lengths are the powers of two that add up to ``total``."""
        queue = deque(k for k in sorted(use, reverse=True) for _ in range(use[k]))
        for power in reversed(range(total.bit_length())):
            room = total & 1 << power
            place = 0
            while place < room:
                k = queue.popleft()
                size = min(k, room - place)
                self._take(k, 1, size, self.sequences, 1, place)
                if size < k:
                    queue.append(k - size)
                place += size
            self.sequences += bool(room)


def _placed(batches, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Each piece's parts: its plan rows are found by (length, rank), layer by layer."""
    layers = []
    for layer in range(int(rows[:, 9].max(initial=-1)) + 1):
        some = rows[rows[:, 9] == layer]
        some = some[np.lexsort((some[:, 1], some[:, 0]))]
        layers.append((some, some[:, 0] << 48 | some[:, 1]))
    for batch in batches:
        length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
        at = np.arange(len(length))
        for some, keys in layers:
            hit = np.searchsorted(keys, length[at] << 48 | rank[at], "right") - 1
            p = some[np.maximum(hit, 0)]
            ok = (hit >= 0) & (p[:, 0] == length[at]) & (rank[at] < p[:, 1] + p[:, 2])
            at, p = at[ok], p[ok]
            if not len(at):
                break
            k = p[:, 8] + rank[at] - p[:, 1]
            out = batch.take(pa.array(at))
            cut = p[:, 4] != length[at]
            yield pa.RecordBatch.from_arrays(
                [out.column("id"), out.column("key"), pa.array(out.column("start").to_numpy() + p[:, 3]),
                 pa.array(p[:, 4]), pa.array(out.column("ids_crc32").to_numpy(), mask=cut), out.column("doc_tokens"),
                 pa.array(p[:, 5] + k // p[:, 6]), pa.array(p[:, 7] + k % p[:, 6] * p[:, 4])], names=_PLACED)


_PLACED = ["id", "key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
_PLACED_TYPE = "id long, key string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _parts_crc(batches, path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    encode = encoder(path)
    for batch in batches:
        crc = []
        for text, start, n in zip(_texts(batch.column("text")), batch.column("start").to_pylist(),
                                  batch.column("length").to_pylist()):
            crc.append(zlib.crc32(_ids(encode, text, end_id)[4 * start:4 * (start + n)]))
        cols = [pa.array(crc, pa.int64()) if c == "ids_crc32" else batch.column(c) for c in _PLACED]
        yield pa.RecordBatch.from_arrays(cols, names=_PLACED)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
         capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one row per piece.

    Every row of ``docs`` is packed: null and empty texts as the end id alone,
    repeated rows each on their own, a null id as any other. A text is cut at
    whole windows, and where a window has slack that no piece fits. All
    sequences are full but the last ones, whose lengths are different powers of
    two: nothing is padded. The texts of pieces that the plan cut are tokenised
    again, for the checksums of their parts. An empty table gives no rows. Only
    the two named columns are read.
    """
    path = path or tokenizer_path()
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.md5(F.coalesce(text_col, F.lit(""))).alias("key"),
                       F.col(text_col).alias("text"))
    cut = write_table(map_arrow(base, lambda it: _pieces(it, path, capacity, end_id),
                                "id long, key string, start long, length long, ids_crc32 long, doc_tokens long"),
                      "pieces")
    loose = cut.filter(F.col("length") < capacity)
    counts = dict(loose.groupBy("length").count().toLocalIterator())         # fewer than ``capacity`` rows
    plan = Plan(counts, capacity)
    rows = np.array(plan.rows, np.int64).reshape(-1, 10)
    ranked = running(loose.withColumn("one", F.lit(1).cast("long")), "length", ["id", "key", "start"], ["one"])
    placed = map_arrow(ranked.withColumnRenamed("before_one", "rank"), lambda it: _placed(it, rows), _PLACED_TYPE)
    placed = write_table(placed, "placed")
    full = cut.filter(F.col("length") == capacity) \
        .withColumn("sequence_id", F.monotonically_increasing_id() + plan.sequences).withColumn("offset", F.lit(0).cast("long"))
    parts = placed.filter("ids_crc32 is null").drop("ids_crc32")
    # the few texts that were cut: a bitmap of their digests prunes the second reading before the join
    again = only_marked(base.select("key", "text"), "key", parts.select("key")).groupBy("key").agg(F.first("text").alias("text"))
    parts = map_arrow(parts.join(again, "key"), lambda it: _parts_crc(it, path, end_id), _PLACED_TYPE)
    return full.select(*_PLACED).unionByName(placed.filter("ids_crc32 is not null")).unionByName(parts).drop("key")
