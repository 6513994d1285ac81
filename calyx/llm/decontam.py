"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit distance.

Symbols are words (ASCII letters, digits and non-ASCII characters, lower-cased
A-Z). An item of n words stands in a text where a stretch of the text is at
most (1 - similarity) * n word edits away. Windows of an item's size are looked
at from every word on, less those that hold fewer of the benchmark's word
triples (pairs, in items of so few words that no triple need survive) than that
many edits could leave: a lossless count filter. The others are embedded by CGK
random walks, which turn edits into Hamming distance, and hashed by sampled
coordinates; windows and items that share a key in any table are candidates.

Walks part for longer, the longer they are, so items of more than ``PIECE``
words are embedded in pieces of so many words, the last one ending with the
item, and windows have a piece's size: one piece that meets proposes the whole
item. Candidates alone are confirmed, by exact edit distance to the text around.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, chunks, map_arrow, mix, shingle_hashes, text_buffers, words

SIMILARITY = 0.8
PIECE = 24                     # words embedded at once
BITS = 3                       # coordinates in a table's key; two in pieces of fewer than SHORT words
SHORT = 12
GAPS = (3, 7)                  # from one coordinate to the next, the upper one exclusive
WALKS = 8                      # independent embeddings
TABLES = 6                     # tables sampled from each
BLOCK_WORDS = 2_000_000        # benchmark words scanned for at once; more make more passes
PENDING = 20_000               # windows that are embedded together
_PAD = np.uint64(0x5BD1E995)
_ROW = np.random.default_rng(5).integers(1, 2**63, PIECE, dtype=np.uint64) | np.uint64(1)


def allowed_edits(n: int, similarity: float = SIMILARITY) -> int:
    """Word edits an item of ``n`` words may be away, few enough that one word pair survives them."""
    return max(0, min(math.floor((1 - similarity) * n + 1e-9), (n - 2) // 2))


class Pieces:
    """Hash tables of the pieces of one size, for windows of that size."""

    def __init__(self, n: int, members: list[tuple[int, int]], item_words: list[np.ndarray], edits: int):
        """``members``: (item, first word); ``edits``: how many a window may be away."""
        self.n, self.edits = n, edits
        self.item, self.at = (np.array(c) for c in zip(*members))
        self.q = next((q for q in (3, 2) if n - q + 1 - q * edits >= 1), 1)
        self.least = max(1, n - self.q + 1 - self.q * edits)
        rng = np.random.default_rng(1000 + n)
        self.salt = rng.integers(1, 2**63, (WALKS, 2 * n), dtype=np.uint64) | np.uint64(1)
        # coordinates close by agree together, but not so close that they are one word; none where walks have ended
        reach, bits = max(1, 3 * n // 2), BITS if n >= SHORT else BITS - 1
        steps = rng.integers(*GAPS, (WALKS, TABLES, bits))
        steps[..., 0] = rng.integers(0, max(1, reach - GAPS[0] * (bits - 1)), (WALKS, TABLES))
        self.sample = np.minimum(np.cumsum(steps, 2), reach - 1)
        self.mult = rng.integers(1, 2**63, (WALKS, TABLES, bits), dtype=np.uint64) | np.uint64(1)
        self.tables = []
        for keys in self.keys(np.stack([item_words[i][a:a + n] for i, a in members])):
            order = np.argsort(keys, kind="stable")
            self.tables.append((keys[order], order))

    def walk(self, w: np.ndarray, salt: np.ndarray) -> np.ndarray:
        """CGK embedding of windows (rows of ``w``): a step copies a word and, on its hash bit, moves on."""
        rows, at = np.arange(len(w)), np.zeros(len(w), np.int64)
        padded = np.concatenate([w, np.full((len(w), 1), _PAD)], 1)
        out = np.empty((2 * self.n, len(w)), np.uint64)
        for j in range(2 * self.n):
            out[j] = padded[rows, at]
            at = np.minimum(at + (out[j] * salt[j] >> np.uint64(63)).astype(np.int64), self.n)
        return out

    def keys(self, w: np.ndarray) -> Iterator[np.ndarray]:
        """Per table the windows' keys of sampled coordinates."""
        for salt, sample, mult in zip(self.salt, self.sample, self.mult):
            walk = self.walk(w, salt)
            for at, m in zip(sample, mult):
                yield mix((walk[at] * m[:, None]).sum(0, dtype=np.uint64))

    def meet(self, w: np.ndarray) -> np.ndarray:
        """Pairs (window, piece) that share a key, distinct."""
        found = [np.zeros((0, 2), np.int64)]
        for keys, (table, order) in zip(self.keys(w), self.tables):
            lo, hi = np.searchsorted(table, keys, "left"), np.searchsorted(table, keys, "right")
            n = hi - lo
            win = np.repeat(np.arange(len(w)), n)
            place = lo[win] + np.arange(len(win)) - np.repeat(np.cumsum(n) - n, n)
            found.append(np.stack([win, order[place]], 1))
        return np.unique(np.concatenate(found), axis=0)


class Benchmark:
    def __init__(self, items: list[tuple], similarity: float):
        """``items``: (item_id, text); those without words match nothing."""
        self.ids, self.words, self.edits = [], [], []
        for item, text in items:
            raw = np.frombuffer((text or "").encode(), np.uint8)
            h, *_ = words(raw, np.array([0, len(raw)]), ALNUM)
            if len(h):
                self.ids.append(item)
                self.words.append(h)
                self.edits.append(allowed_edits(len(h), similarity))
        by_size: dict[int, list[tuple[int, int]]] = {}
        for i, w in enumerate(self.words):
            n = len(w)
            # some piece has no more edits than its share, rounded up
            starts = [0] if n <= PIECE else [*range(0, n - PIECE, PIECE), n - PIECE]
            by_size.setdefault((min(n, PIECE), n <= PIECE), []).extend((i, a) for a in starts)
        self.sizes = []
        for (n, alone), members in sorted(by_size.items()):
            edits = allowed_edits(n, similarity) if alone else min(math.ceil((1 - similarity) * n - 1e-9), (n - 2) // 2)
            self.sizes.append(Pieces(n, members, self.words, edits))
        self.reach = max((s.n + s.edits for s in self.sizes), default=0)
        self.grams, self.seen = {}, {}
        for q in {s.q for s in self.sizes}:
            of = {int(i) for s in self.sizes if s.q == q for i in s.item}
            self.grams[q] = np.unique(np.concatenate([shingle_hashes(self.words[i], q) for i in of]))
            self.seen[q] = np.zeros(1 << 20, bool)
            self.seen[q][self.grams[q] & np.uint64((1 << 20) - 1)] = True

    def hits(self, h: np.ndarray, left: np.ndarray, q: int) -> np.ndarray:
        """The words from which on ``q`` words are a gram of an item (``left``: words to the text's end)."""
        g = shingle_hashes(h, q)
        maybe = np.flatnonzero(self.seen[q][g & np.uint64((1 << 20) - 1)])
        maybe = maybe[left[maybe] >= q]
        at = np.searchsorted(self.grams[q], g[maybe])
        at[at == len(self.grams[q])] = 0
        return maybe[self.grams[q][at] == g[maybe]]

    def windows(self, h: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(size, documents, starts) of the windows that pass the count filter, from texts' word hashes."""
        n_words = len(h)
        if not n_words:
            return
        end, left, sums, near = None, None, {}, {}
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        end = first[1:][doc]
        left = end - np.arange(n_words)
        for q in self.grams:
            p = self.hits(h, left, q)
            count = np.zeros(n_words + 1, np.int64)
            count[p + 1] = 1
            sums[q] = np.cumsum(count)
            mark = np.zeros(n_words + 1, np.int64)
            np.add.at(mark, np.maximum(first[doc[p]], p - self.reach), 1)
            np.add.at(mark, p + 1, -1)
            near[q] = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
        for k, size in enumerate(self.sizes):
            s = near[size.q]
            s = s[left[s] >= max(1, size.n - size.edits)]
            last = np.minimum(s + size.n + size.edits - size.q + 1, np.maximum(s, end[s] - size.q + 1))
            s = s[sums[size.q][last] - sums[size.q][s] >= size.least]
            if len(s):
                yield k, doc[s], s - first[doc[s]]


class Pending:
    """Windows of several chunks of text, embedded together; texts without any are forgotten at once."""

    def __init__(self, bench: Benchmark):
        self.bench = bench
        self.clear()

    def clear(self) -> None:
        self.texts, self.ids, self.found, self.count = [], [], {}, 0

    def add(self, ids: pa.Array, h: np.ndarray, first: np.ndarray) -> None:
        place: dict[int, int] = {}
        for k, docs, starts in self.bench.windows(h, first):
            for d in np.unique(docs):
                if int(d) not in place:
                    place[int(d)] = len(self.texts)
                    self.texts.append(h[first[d]:first[d + 1]].copy())
                    self.ids.append(ids[int(d)].as_py())
            n = self.bench.sizes[k].n
            at = starts[:, None] + np.arange(n)
            w = np.where(at < np.diff(first)[docs][:, None], h[np.minimum(first[docs][:, None] + at, len(h) - 1)], _PAD)
            self.found.setdefault(k, []).append((w, np.array([place[int(d)] for d in docs]), starts))
            self.count += len(starts)

    def matches(self) -> Iterator[tuple]:
        """(id, item place, distance, start word, end word, places) of all that is pending."""
        bench, regions = self.bench, {}
        for k, parts in self.found.items():
            size = bench.sizes[k]
            w, doc, start = (np.concatenate(c) for c in zip(*parts))
            _, one, which = np.unique((w * _ROW[:size.n]).sum(1, dtype=np.uint64), return_index=True, return_inverse=True)
            pair = size.meet(w[one])                                 # copies of a passage are embedded once
            order = np.argsort(which, kind="stable")
            lo = np.searchsorted(which[order], pair[:, 0])
            n = np.searchsorted(which[order], pair[:, 0], "right") - lo
            at = np.repeat(np.arange(len(pair)), n)
            win = order[lo[at] + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)]
            piece = pair[at, 1]
            begin = start[win] - size.at[piece]                      # where the item would begin
            for d, item, b in np.unique(np.stack([doc[win], size.item[piece], begin], 1), axis=0).tolist():
                slack = bench.edits[item] + size.edits
                span = max(0, b - slack), min(len(self.texts[d]), b + len(bench.words[item]) + slack)
                regions.setdefault((d, item), []).append(span)
        for (d, item), spans in regions.items():
            got = []
            for a, b in _merged(spans):
                distance, x, y = best_stretch(bench.words[item], self.texts[d][a:b])
                if distance <= bench.edits[item]:
                    got.append((distance, a + x, a + y))
            if got:
                yield self.ids[d], item, *min(got), len(got)
        self.clear()


def _merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def best_stretch(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Least word edits between ``item`` and any stretch of ``text``, with that stretch (the earliest end)."""
    last = _distances(item, text, True)
    stop = int(last.argmin())
    back = _distances(item[::-1], text[:stop][::-1], False)
    return int(last[stop]), stop - int(back.argmin()), stop


def _distances(item: np.ndarray, text: np.ndarray, free_start: bool) -> np.ndarray:
    """Edit distances of the whole item to the stretches that end at each place of the text."""
    ramp = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64) if free_start else ramp.copy()
    for i, w in enumerate(item, 1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (text != w))
        row = np.minimum.accumulate(new - ramp) + ramp
    return row


def _scan(batches, bench: Benchmark) -> Iterator[pa.RecordBatch]:
    pending = Pending(bench)

    def found():
        out = [(i, bench.ids[item], len(bench.words[item]), *rest) for i, item, *rest in pending.matches()]
        if out:
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out)],
                                  names=["id", "item_id", "item_words", "distance", "start_word", "end_word", "places"])

    for batch in batches:
        data, offsets = text_buffers(batch.column(1))
        for i, j, raw, off in chunks(data, offsets):
            h, _, _, first = words(raw, off, ALNUM)
            pending.add(batch.column(0).slice(i, j - i), h, first)
            if pending.count >= PENDING:
                yield from found()
    yield from found()


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", similarity: float = SIMILARITY,
                 block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per text and benchmark item that stands in it.

    Columns: id, item_id, item_words, distance (word edits), start_word,
    end_word (exclusive, of the nearest stretch, the earliest among equals),
    places (separate stretches found), similarity (1 - distance / item_words).
    Null, empty and wordless texts and items match nothing; items of fewer than
    five words must stand unchanged; repeated rows and null ids give rows each
    of their own; an empty table on either side gives none. Only the named
    columns are read. The benchmark is taken in blocks of about ``block_words``
    words, each small enough for every task to hold, with a pass over ``docs``
    for each.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("body")) \
        .filter("body is not null")
    total = items.agg(F.sum(F.size(F.split("body", r"\s+")))).first()[0] or 0
    blocks = -(-total // block_words)
    out = spark.createDataFrame([], "id long, item_id long, item_words long, distance long, start_word long, "
                                    "end_word long, places long")
    for k in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item", "body"), F.lit(blocks)) == k).collect()
        bench = Benchmark(sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1])),
                          similarity)
        texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
        out = out.unionByName(map_arrow(texts, lambda it, b=bench: _scan(it, b), out.schema))
    return out.withColumn("similarity", 1 - F.col("distance") / F.col("item_words"))
