"""Quality classifier from weak labels.

Overlapping heuristic labellers vote on every document: some on its form
(symbols, capitals, repetition ...), some on abusive words, whose lexicons are
learned from a bounded sample of the labels table. Expectation-maximisation over
the counts of vote patterns of the whole corpus estimates how accurate each
labeller is, for form and abuse each. The posteriors label a bounded sample of
documents that trains two hashed linear scorers (logistic regression, one over
binned form statistics, one over words and word stems), and the scorers decide on
every document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ALNUM, NOT_SPACE, chunks, map_arrow, mix, smallest_hashes, text_buffers, words, write_table

HASH_BITS = 44                 # wide enough that a long text meets no lexicon entry by chance
STEMS = (4, 5, 6, 7, 8)        # a word's first bytes so many are features: inflected words share them
LABELLED = 1_000               # labelled documents per class that teach the lexicons
EVIDENCE = 30.0                # log-likelihood ratio from which a feature counts, far beyond chance among millions
ABUSE_FROM = 0.1               # abuse score from which a text isn't kept: one pure word in a short text is enough
PURITY = 200                   # times as common in abusive documents as in others, for a word of the lexicon
TRAINING = 1_000               # documents per side and scorer that train it
BAD, GOOD, SILENT = 1, 0, 2

_UPPER = np.zeros(256, np.int32)
_UPPER[65:91] = 1
_LETTER = _UPPER.copy()
_LETTER[97:123] = 1
_SYMBOL = np.ones(256, np.int32)
_SYMBOL[:33] = _SYMBOL[48:58] = _SYMBOL[65:91] = _SYMBOL[97:123] = _SYMBOL[127:] = 0
_ENDS_WELL = np.zeros(256, bool)
_ENDS_WELL[48:58] = _ENDS_WELL[65:91] = _ENDS_WELL[97:123] = _ENDS_WELL[128:] = True
_ENDS_WELL[[ord(c) for c in ".,;:!?)\"'"]] = True
_PLAIN = np.zeros(256, np.int32)
_PLAIN[48:58] = _PLAIN[65:91] = _PLAIN[97:123] = _PLAIN[128:] = 1

#: labeller: the statistic it looks at, fine up to the first and voted bad from the second, least words to vote.
#: Each knows one kind of junk and is silent otherwise; two more vote good where a whole group of statistics is fine.
FORM_LABELLERS = (
    ("symbols", 0.06, 0.13, 8), ("capitals", 0.12, 0.5, 8), ("commonest", 0.15, 0.3, 20), ("sameness", 0.45, 0.7, 20),
    ("stutter", 0.05, 0.2, 8), ("odd_ends", 0.04, 0.2, 8), ("marks", 0.03, 0.15, 8), ("long_words", 9.0, 15.0, 8),
)
STATS = tuple(x[0] for x in FORM_LABELLERS)
FINE_GROUPS = (("symbols", "capitals", "odd_ends", "marks"), ("commonest", "sameness", "stutter", "long_words"))
BINS = 12                      # form features per statistic


def form_stats(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words per document, and its statistics (document, STATS)."""
    h, starts, ends, first = words(raw, offsets, NOT_SPACE)
    n_docs, n = len(offsets) - 1, np.diff(first)
    some = np.maximum(n, 1)
    doc = np.repeat(np.arange(n_docs), n)

    def total(table):
        c = np.concatenate([[0], np.cumsum(table[raw])])
        return c[offsets[1:]] - c[offsets[:-1]]

    size = np.maximum(np.diff(offsets), 1)
    out = np.zeros((n_docs, len(STATS)))
    out[:, 0] = total(_SYMBOL) / size
    out[:, 1] = total(_UPPER) / np.maximum(total(_LETTER), 1)
    pair, count = np.unique(mix(h + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_counts=True) \
        if len(h) else (h, n[:0])
    if len(h):
        place = np.searchsorted(pair, mix(h + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        most, distinct = np.zeros(n_docs), np.zeros(n_docs)
        np.maximum.at(most, doc, count[place])
        np.add.at(distinct, doc, 1.0 / count[place])
        out[:, 2] = most / some
        # long texts repeat words by nature: expect distinct words to grow with the root of the length
        out[:, 3] = 1 - np.minimum(1, distinct / np.minimum(some, 14 * np.sqrt(some)))
        again = np.zeros(len(h), bool)
        again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
        out[:, 4] = np.bincount(doc[again], minlength=n_docs) / some
        out[:, 5] = np.bincount(doc[~_ENDS_WELL[raw[ends - 1]]], minlength=n_docs) / some
        plain = np.concatenate([[0], np.cumsum(_PLAIN[raw])])
        out[:, 6] = np.bincount(doc[plain[ends] == plain[starts]], minlength=n_docs) / some
    out[:, 7] = np.minimum(size / some, 60)
    return n, out


def form_votes(n: np.ndarray, stats: np.ndarray) -> np.ndarray:
    """(document, labeller) votes on form."""
    votes = np.full((len(n), len(STATS) + len(FINE_GROUPS)), SILENT, np.int8)
    fine = np.zeros(stats.shape, bool)
    for k, (_, good, bad, least) in enumerate(FORM_LABELLERS):
        fine[:, k] = stats[:, k] <= good
        votes[(stats[:, k] >= bad) & (n >= least), k] = BAD
    for g, group in enumerate(FINE_GROUPS):
        votes[fine[:, [STATS.index(x) for x in group]].all(1) & (n > 0), len(STATS) + g] = GOOD
    return votes


def word_features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(1 + stems, words) hashed features of words and word stems, and each document's first word."""
    h, _, _, first, *stems = words(raw, offsets, ALNUM, True, STEMS)
    mask, base = np.uint64((1 << HASH_BITS) - 1), np.uint64(len(STATS) * BINS)
    return (np.stack([h, *stems]) & mask) + base, first


def features(raw: np.ndarray, offsets: np.ndarray, n: np.ndarray, stats: np.ndarray) -> Iterator[np.ndarray]:
    """Per document its distinct hashed features: words, word stems, form bins."""
    found, first = word_features(raw, offsets)
    edges = np.array([[good + (bad - good) * (b - 2) / (BINS - 4) for b in range(1, BINS)]
                      for _, good, bad, _ in FORM_LABELLERS])
    for d in range(len(n)):
        bins = np.array([k * BINS + np.searchsorted(edges[k], stats[d, k]) for k in range(len(STATS))], np.uint64)
        yield np.unique(np.concatenate([bins, found[:, first[d]:first[d + 1]].ravel()])).astype(np.int64)


def _documents(batch, id_at: int, text_at: int) -> Iterator[tuple]:
    data, offsets = text_buffers(batch.column(text_at))
    for i, j, raw, off in chunks(data, offsets):
        n, stats = form_stats(raw, off)
        yield batch.column(id_at).slice(i, j - i), raw, off, n, stats


# --------------------------------------------------------------- label model
class LabelModel:
    """Two classes and independent labellers; a vote's chance depends on the class."""

    def __init__(self, votes: np.ndarray, weight: np.ndarray, rounds: int = 60):
        """``votes``: (pattern, labeller); ``weight``: documents with that pattern."""
        bad, good = (votes == BAD).sum(1), (votes == GOOD).sum(1)
        p = np.where(bad + good > 0, (bad + 0.02) / (bad + good + 0.2), 0.1)
        self.labellers = votes.shape[1]
        for _ in range(rounds):
            self.prior = float(np.clip((p * weight).sum() / max(weight.sum(), 1e-9), 1e-4, 1 - 1e-4))
            self.chance = np.zeros((2, self.labellers, 3))          # class, labeller, vote
            for c, q in ((BAD, p), (GOOD, 1 - p)):
                for v in (GOOD, BAD, SILENT):
                    self.chance[c, :, v] = ((votes == v) * (q * weight)[:, None]).sum(0) + 0.5
            self.chance /= self.chance.sum(2, keepdims=True)
            p = self.posterior(votes)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of the bad class per row of ``votes``; silence is no evidence."""
        at = np.arange(self.labellers)
        ratio = np.log(self.chance[BAD]) - np.log(self.chance[GOOD])
        ratio[:, SILENT] = 0
        odds = ratio[at[None, :], votes].sum(1) + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))

    def accuracy(self) -> np.ndarray:
        """Estimated chance that a labeller that votes is right."""
        right = self.prior * self.chance[BAD, :, BAD] + (1 - self.prior) * self.chance[GOOD, :, GOOD]
        wrong = self.prior * self.chance[BAD, :, GOOD] + (1 - self.prior) * self.chance[GOOD, :, BAD]
        return right / (right + wrong)


# -------------------------------------------------------------------- scorer
def evidence(c1: np.ndarray, c0: np.ndarray, n1: float, n0: float) -> np.ndarray:
    """Log-likelihood ratio that a feature's share differs between the classes (counts c of n documents)."""
    def part(c, n, share):
        share = np.clip(share, 1e-12, 1 - 1e-12)
        return c * np.log(share) + (n - c) * np.log(1 - share)

    both = (c1 + c0) / (n1 + n0)
    return 2 * (part(c1, n1, c1 / n1) + part(c0, n0, c0 / n0) - part(c1, n1, both) - part(c0, n0, both))


def fit_linear(rows: list[np.ndarray], y: np.ndarray, rounds: int = 2000, rate: float = 0.3,
               penalty: float = 1e-5, least: float = EVIDENCE, purity: float = 0.0) -> tuple[np.ndarray, np.ndarray, float]:
    """(features, weights, bias) of a logistic regression over sets of hashed features.

    Only features with ``least`` evidence that their share differs between the
    classes take part, so chance words of long texts carry no weight; with
    ``purity``, only those so many times as common in class 1.
    """
    if not len(rows) or y.min() == y.max():
        return np.zeros(0, np.int64), np.zeros(0), float(10 * (y.mean() - 0.5)) if len(rows) else 0.0
    flat = np.concatenate(rows)
    size = np.array([len(r) for r in rows])
    used, col = np.unique(flat, return_inverse=True)
    row = np.repeat(np.arange(len(rows)), size)
    n1, n0 = y.sum(), (1 - y).sum()
    c1 = np.bincount(col, weights=y[row], minlength=len(used))
    c0 = np.bincount(col, minlength=len(used)) - c1
    keep = (evidence(c1, c0, n1, n0) >= least) & (c1 / n1 > purity * (c0 / n0))
    chosen = np.flatnonzero(keep)
    new = np.cumsum(keep) - 1
    at = keep[col]
    row, col = row[at], new[col[at]]
    w, bias, m, v = np.zeros(len(chosen)), 0.0, np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    weight = np.where(y == 1, 0.5 / n1, 0.5 / n0)
    for t in range(1, rounds + 1):
        margin = np.bincount(row, weights=w[col], minlength=len(y)) + bias
        err = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y) * weight
        g = np.append(np.bincount(col, weights=err[row], minlength=len(w)) + penalty * w, err.sum())
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        step = rate * min(1, 2 * (1 - (t - 1) / rounds)) * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
        w -= step[:-1]
        bias -= step[-1]
    return used[chosen], w, bias


class Lookup:
    """Few of many hashed features: a small table of their low bits, then an exact search."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.sort(np.asarray(keys, np.int64))
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.keys & 0xFFFFF] = True

    def __call__(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``found`` that hold one of the keys, and where among the sorted keys."""
        at = np.flatnonzero(self.maybe[found & np.array(0xFFFFF, found.dtype)])
        if not len(at) or not len(self.keys):
            return at[:0], at[:0]
        where = np.minimum(np.searchsorted(self.keys, found[at].astype(np.int64)), len(self.keys) - 1)
        same = self.keys[where] == found[at].astype(np.int64)
        return at[same], where[same]


# -------------------------------------------------------------------- passes
def _featured(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(i, f) for ids, raw, off, n, stats in _documents(batch, 0, 1)
                for i, f in zip(ids.to_pylist(), features(raw, off, n, stats))]
        size = [len(f) for _, f in rows]
        flat = np.concatenate([f for _, f in rows]) if rows else np.zeros(0, np.int64)
        yield pa.record_batch([pa.array([i for i, _ in rows], pa.int64()),
                               pa.ListArray.from_arrays(pa.array(np.cumsum([0, *size]), pa.int32()), pa.array(flat))],
                              names=["id", "features"])


def _feature_rows(docs: DataFrame) -> list[tuple[int, np.ndarray]]:
    """(id, features) of a bounded sample of documents, by id."""
    table = map_arrow(docs.select("id", "text"), _featured, "id long, features array<long>").toArrow()
    out = []
    for batch in table.to_batches():
        ids, lists = batch.column(0).to_pylist(), batch.column(1)
        flat, at = lists.values.to_numpy(), lists.offsets.to_numpy()
        out.extend((i, flat[a:b]) for i, a, b in zip(ids, at, at[1:]))
    return sorted(out, key=lambda r: r[0])


def _voted(batches, lexicons: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    tables = [Lookup(lexicon) for lexicon in lexicons]
    for batch in batches:
        for ids, raw, off, n, stats in _documents(batch, 0, 1):
            seen, first = word_features(raw, off)
            doc = np.repeat(np.arange(len(n)), np.diff(first))
            abuse = np.full((len(n), len(tables)), GOOD, np.int8)
            for k, table in enumerate(tables):
                for kind in seen:
                    abuse[doc[table(kind)[0]], k] = BAD
            abuse[n == 0] = SILENT
            form = form_votes(n, stats)
            text = lambda v: pa.array(["".join(map(str, r)) for r in v.tolist()])
            yield pa.record_batch([ids, pa.array(n, pa.int64()), text(form), text(abuse)],
                                  names=["id", "n_words", "form", "abuse"])


def _scored(batches, form_model: tuple, abuse_model: tuple) -> Iterator[pa.RecordBatch]:
    tables = [(Lookup(used), weights, bias) for used, weights, bias in (form_model, abuse_model)]
    for batch in batches:
        for ids, raw, off, n, stats in _documents(batch, 0, 1):
            p = np.zeros((2, len(n)))
            for d, f in enumerate(features(raw, off, n, stats)):
                for k, (table, weights, bias) in enumerate(tables):
                    p[k, d] = weights[table(f)[1]].sum() + bias
            p = 1 / (1 + np.exp(-np.clip(p, -30, 30)))
            yield pa.record_batch([ids, pa.array(n, pa.int64()), pa.array(1 - p[0]), pa.array(p[1])],
                                  names=["id", "n_words", "quality", "abuse"])


def _lexicons(docs: DataFrame, labels: DataFrame, labelled: int) -> list[np.ndarray]:
    """Abusive words and stems by hashed feature: from even ids, from odd ids, from all labelled documents."""
    some = smallest_hashes(labels.filter("lid is not null and toxic in (0, 1)").groupBy("lid")
                           .agg(F.max("toxic").alias("toxic")), "toxic", "lid", labelled).select("lid", "toxic")
    # at most 2 * ``labelled`` ids
    picked = docs.join(F.broadcast(some), F.col("id") == F.col("lid")).select("id", "text", "toxic")
    toxic = {r[0]: r[1] for r in some.collect()}
    rows = _feature_rows(picked)
    y = np.array([toxic[r[0]] for r in rows])
    half = np.array([r[0] % 2 for r in rows])
    out = []
    for part in (half == 0, half == 1, half >= 0):
        n1, n0 = int((part & (y == 1)).sum()), int((part & (y == 0)).sum())
        if not n1 or not n0:
            out.append(np.zeros(0, np.int64))
            continue
        counted = [np.unique(np.concatenate([rows[k][1] for k in np.flatnonzero(part & (y == c))]),
                             return_counts=True) for c in (1, 0)]
        used, c1 = counted[0]
        at = np.minimum(np.searchsorted(counted[1][0], used), len(counted[1][0]) - 1)
        c0 = np.where(counted[1][0][at] == used, counted[1][1][at], 0)
        out.append(used[(c1 / n1 > PURITY * (c0 / n0)) & (evidence(c1, c0, n1, n0) >= EVIDENCE)])
    return out


def _patterns(votes: DataFrame, column: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The vote patterns (at most 3 ** labellers rows) and the documents that have them."""
    rows = votes.filter("n_words > 0").groupBy(column).count().orderBy(column).collect()
    return ([r[0] for r in rows], np.array([[int(c) for c in r[0]] for r in rows], np.int64),
            np.array([r[1] for r in rows], float))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             labelled: int = LABELLED, training: int = TRAINING) -> DataFrame:
    """(id, n_words, quality, abuse, kept) per row of ``docs``.

    ``labels`` needs doc_id and toxic (0 or 1); its quality column isn't used.
    quality is the scorer's probability of good form, abuse that of abusive
    words; kept where quality >= 0.5 and abuse < ABUSE_FROM. Texts without words, null
    and empty ones included, have quality 0 and aren't kept. Repeated rows are
    scored one by one (only one of them may train); rows with a null id are
    scored but train nothing; an empty table gives no rows; without labels of
    both kinds no text counts as abusive. Other columns aren't read.

    Bounds: at most ``labelled`` labelled documents per toxic value and
    ``training`` per side and scorer come to the driver, as hashed features,
    picked by the hash of their id; votes, posteriors and scores cover all.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    named = labels.select(F.col("doc_id").cast("long").alias("lid"), F.col("toxic").cast("int").alias("toxic"))
    lexicons = _lexicons(base, named, labelled)
    votes = write_table(map_arrow(base, lambda it: _voted(it, lexicons),
                                  "id long, n_words long, form string, abuse string"), "votes")
    models, spark = [], docs.sparkSession
    for column in ("form", "abuse"):
        names, pattern, weight = _patterns(votes, column)
        if not names:
            return spark.createDataFrame([], "id long, n_words long, quality double, abuse double, kept boolean") \
                if votes.isEmpty() else votes.select("id", "n_words", F.lit(0.0).alias("quality"),
                                                     F.lit(0.0).alias("abuse"), F.lit(False).alias("kept"))
        if (pattern == BAD).any():
            side = LabelModel(pattern, weight).posterior(pattern) >= 0.5
        else:
            side = np.zeros(len(names), bool)
        # of a side of n documents, those among the smallest 3 * training / n of the hashes hold the sample
        cut = {s: min(2**63 - 1, int(-2**63 + min(1.0, 3 * training / weight[side == s].sum()) * 2**64))
               for s in set(side.tolist())}
        sides = spark.createDataFrame([(p, int(s), cut[s]) for p, s in zip(names, side.tolist())],
                                      f"{column} string, side int, cut long")
        order = Window.partitionBy("side").orderBy(F.xxhash64("id"), "id")
        some = votes.filter("n_words > 0 and id is not null").join(F.broadcast(sides), column) \
            .filter(F.xxhash64("id") <= F.col("cut")).groupBy("id").agg(F.max("side").alias("side")) \
            .withColumn("r", F.row_number().over(order)).filter(F.col("r") <= training).select("id", "side")
        models.append({r[0]: r[1] for r in some.collect()})
    wanted = spark.createDataFrame([(i,) for i in sorted(set().union(*models))], "id long")
    found = dict(_feature_rows(base.join(F.broadcast(wanted), "id")))
    fitted = []
    bins = len(STATS) * BINS                     # form is told by the bins, abuse by words and stems
    for of, own, purity in zip(models, (lambda f: f[f < bins], lambda f: f[f >= bins]), (0.0, PURITY)):
        ids = sorted(i for i in of if i in found)
        fitted.append(fit_linear([own(found[i]) for i in ids], np.array([of[i] for i in ids], float), purity=purity))
    scored = map_arrow(base, lambda it: _scored(it, *fitted), "id long, n_words long, quality double, abuse double")
    empty = F.col("n_words") == 0
    return scored.select(
        "id", "n_words", F.when(empty, 0.0).otherwise(F.col("quality")).alias("quality"),
        F.when(empty, 0.0).otherwise(F.col("abuse")).alias("abuse"),
        (~empty & (F.col("quality") >= 0.5) & (F.col("abuse") < ABUSE_FROM)).alias("kept"))
