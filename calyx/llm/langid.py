"""Language identification: a bidirectional gated recurrent network over bytes, in numpy.

Texts are cut into segments of 64 bytes that run side by side as one batch, so
a step of the recurrence is one small matrix product for thousands of segments.
Every byte position gets label probabilities; a document's are the mean over
the positions of its letters. Training is backpropagation through time with
Adam on segments of a bounded, documented sample of labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, map_arrow, smallest_hashes, text_buffers

SEGMENT = 64
HIDDEN = 8
SAMPLE_DOCS = 200              # labelled documents per language that train the network
SAMPLE_SEGMENTS = 8            # segments of each, spread over its whole text
STEPS, BATCH = 160, 256
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _tanh(x: np.ndarray) -> np.ndarray:
    return np.tanh(x)


class Direction:
    """One gated recurrent layer over one direction; byte inputs are rows of ``E``."""

    def __init__(self, rng, h: int):
        self.h = h
        self.E = (rng.standard_normal((256, 3 * h)) * 0.3).astype(np.float32)
        self.E[:, :h] -= 1.0                                       # start by keeping the state
        self.U = (rng.standard_normal((h, 3 * h)) / np.sqrt(h)).astype(np.float32)
        self.b = np.zeros(3 * h, np.float32)

    def run(self, x: np.ndarray, keep: list | None = None) -> np.ndarray:
        """``x``: (steps, segments) bytes; the states after each step."""
        h, (steps, n) = self.h, x.shape
        state, out = np.zeros((n, h), np.float32), np.empty((steps, n, h), np.float32)
        for t in range(steps):
            a = self.E[x[t]]
            u = state @ self.U + self.b
            g = _sigmoid(a[:, :2 * h] + u[:, :2 * h])
            z, r = g[:, :h], g[:, h:]
            c = _tanh(a[:, 2 * h:] + r * u[:, 2 * h:])
            if keep is not None:
                keep.append((state, z, r, c, u[:, 2 * h:]))
            state = c + z * (state - c)
            out[t] = state
        return out

    def back(self, x: np.ndarray, keep: list, d_out: np.ndarray) -> list[np.ndarray]:
        """Gradients of E, U and b, from those of the states."""
        h = self.h
        dE, dU, db = np.zeros_like(self.E), np.zeros_like(self.U), np.zeros_like(self.b)
        ds = np.zeros_like(d_out[0])
        for t in range(len(x) - 1, -1, -1):
            state, z, r, c, uc = keep[t]
            ds = ds + d_out[t]
            dz = ds * (state - c) * z * (1 - z)
            dc = ds * (1 - z) * (1 - c * c)
            dr = dc * uc * r * (1 - r)
            da = np.concatenate([dz, dr, dc], 1)
            du = np.concatenate([dz, dr, dc * r], 1)
            np.add.at(dE, x[t], da)
            dU += state.T @ du
            db += du.sum(0)
            ds = ds * z + du @ self.U.T
        return [dE, dU, db]


class Network:
    def __init__(self, labels: list[str], hidden: int = HIDDEN, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.labels = labels
        self.forward, self.backward = Direction(rng, hidden), Direction(rng, hidden)
        self.W = (rng.standard_normal((2 * hidden, len(labels))) * 0.3).astype(np.float32)
        self.c = np.zeros(len(labels), np.float32)

    def parameters(self) -> list[np.ndarray]:
        f, b = self.forward, self.backward
        return [f.E, f.U, f.b, b.E, b.U, b.b, self.W, self.c]

    def states(self, x: np.ndarray, keep=(None, None)) -> np.ndarray:
        return np.concatenate([self.forward.run(x, keep[0]), self.backward.run(x[::-1], keep[1])[::-1]], 2)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """(steps, segments, labels) for (steps, segments) bytes."""
        s = self.states(x)
        p = s.reshape(-1, s.shape[2]) @ self.W + self.c
        p -= p.max(1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(1, keepdims=True)
        return p.reshape(*x.shape, -1)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross entropy over positions, and its gradients."""
        keep, h = ([], []), self.forward.h
        s = self.states(x, keep)
        flat = s.reshape(-1, 2 * h)
        p = flat @ self.W + self.c
        p -= p.max(1, keepdims=True)
        p = np.exp(p)
        p /= p.sum(1, keepdims=True)
        target = np.tile(y, len(x))
        at = np.arange(len(target))
        loss = float(-np.log(p[at, target] + 1e-12).mean())
        p[at, target] -= 1
        p /= len(target)
        ds = (p @ self.W.T).reshape(s.shape)
        return loss, [*self.forward.back(x, keep[0], ds[:, :, :h]),
                      *self.backward.back(x[::-1], keep[1], ds[::-1, :, h:]),
                      flat.T @ p, p.sum(0)]


def train(segments: np.ndarray, y: np.ndarray, labels: list[str], hidden: int = HIDDEN, steps: int = STEPS,
          batch: int = BATCH, rate: float = 0.03, seed: int = 5) -> Network:
    """Fit a network to (segments, 64) bytes with labels ``y``, every label drawn equally often."""
    net, rng = Network(labels, hidden, seed), np.random.default_rng(seed + 1)
    of = [np.flatnonzero(y == k) for k in range(len(labels))]
    params = net.parameters()
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(ix, max(1, batch // len(labels))) for ix in of])
        _, grads = net.gradients(np.ascontiguousarray(segments[pick].T), y[pick])
        size = np.sqrt(sum(float((g * g).sum()) for g in grads))
        lr = rate * min(1.0, 2 * (1 - (step - 1) / steps))
        for p, g, a, b in zip(params, grads, m, v):
            g = g * np.float32(min(1.0, 1.0 / (size + 1e-12)))
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            p -= np.float32(lr) * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
    return net


def cut(raw: np.ndarray, offsets: np.ndarray, size: int = SEGMENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(steps, segments) bytes, zero after a text's end; each segment's document; segment lengths."""
    length = np.diff(offsets)
    n = -(-length // size)
    doc = np.repeat(np.arange(len(n)), n)
    start = offsets[:-1][doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * size
    real = np.minimum(size, offsets[1:][doc] - start)
    padded = np.concatenate([raw, np.zeros(size, np.uint8)])
    x = padded[start[None, :] + np.arange(size)[:, None]]
    x[np.arange(size)[:, None] >= real[None, :]] = 0
    return x, doc, real


def _sampled(batches, segments: int, size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out, langs = [], []
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            raw = text.encode()
            last = max(0, len(raw) - size)
            for at in sorted({round(last * k / max(1, segments - 1)) for k in range(segments)}):
                out.append(raw[at:at + size].ljust(size, b"\0"))
                langs.append(lang)
        yield pa.record_batch([pa.array(langs, pa.string()), pa.array(out, pa.binary())], names=["lang", "segment"])


def sample(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, segments: int = SAMPLE_SEGMENTS,
           size: int = SEGMENT) -> list[tuple[str, bytes]]:
    """Segments of at most ``sample_docs`` documents per language (smallest hash of the id), all over their texts."""
    # ids are picked before texts are touched: at most ``sample_docs`` for each language
    picked = smallest_hashes(labelled, "lang", "id", sample_docs).distinct() \
        .select(F.col("lang").alias("picked_lang"), F.col("id").alias("picked"))
    some = labelled.join(F.broadcast(picked), (F.col("id") == F.col("picked")) & (F.col("lang") == F.col("picked_lang")))
    cuts = map_arrow(some.select("lang", "text"), lambda it: _sampled(it, segments, size),
                     "lang string, segment binary")
    return sorted((r[0], bytes(r[1])) for r in cuts.collect())


def _predicted(batches, net: Network, size: int) -> Iterator[pa.RecordBatch]:
    labels = np.array(net.labels, object)
    for batch in batches:
        n, letters = len(batch), batch.column(2).to_numpy(zero_copy_only=False)
        data, offsets = text_buffers(batch.column(1))
        total, seen = np.zeros((n, len(labels))), np.zeros(n)
        for i, j, raw, off in chunks(data, offsets, 1 << 18):
            x, doc, real = cut(raw, off, size)
            for lo in range(0, x.shape[1], 4096):
                part, ds = x[:, lo:lo + 4096], doc[lo:lo + 4096]
                p = net.probabilities(np.ascontiguousarray(part))
                weight = _LETTER[part].astype(np.float32)
                seg = np.einsum("tsk,ts->sk", p, weight)
                np.add.at(total, i + ds, seg)
                np.add.at(seen, i + ds, weight.sum(0))
        mean = total / np.maximum(seen, 1)[:, None]
        best = mean.argmax(1)
        known = letters & (seen > 0)
        yield pa.record_batch([batch.column(0), batch.column(3),
                               pa.array(np.where(known, labels[best], "und"), pa.string()),
                               pa.array(np.clip(np.where(known, mean[np.arange(n), best], 0.0), 0, 1))],
                              names=["id", "held_out", "lang_pred", "score"])


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             sample_docs: int = SAMPLE_DOCS, hidden: int = HIDDEN, steps: int = STEPS) -> DataFrame:
    """(id, held_out, lang_pred, score) per row, from the text alone.

    Rows whose crc32 of the id as text leaves 2 modulo 4 are held out; the
    others with a label and a letter may train, at most ``sample_docs`` per
    language. lang_pred is a learned label, or ``und`` with score 0 where the
    text is null, empty or without a letter, and for all rows if no row may
    train; score is the mean probability of the label over the letters of the
    whole text. Ties go to the label first in order. Rows with a null id are
    answered, train nothing and count as not held out; repeated rows are
    answered one by one. Only the three named columns are read.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                       F.col(lang_col).alias("lang"))
    base = base.withColumn("letters", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    base = base.withColumn("held_out", F.coalesce(
        F.crc32(F.col("id").cast("string").cast("binary")) % 4 == 2, F.lit(False)))
    rows = sample(base.filter("lang is not null and id is not null and letters and not held_out"), sample_docs)
    if not rows:
        return base.select("id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    labels = sorted({r[0] for r in rows})
    place = {k: i for i, k in enumerate(labels)}
    net = train(np.frombuffer(b"".join(r[1] for r in rows), np.uint8).reshape(len(rows), SEGMENT),
                np.array([place[r[0]] for r in rows]), labels, hidden, steps)
    return map_arrow(
        base.select("id", "text", "letters", "held_out"), lambda it: _predicted(it, net, SEGMENT),
        "id long, held_out boolean, lang_pred string, score double")
