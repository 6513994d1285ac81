"""Best-fit packing planned over a histogram of lengths.

Texts are tokenised once; only piece lengths travel. The plan is made from the
counts of each length (at most ``capacity`` rows, whatever the corpus), longest
first, each length going to the open sequences with the least room that still
holds it. A plan row says: pieces of length L with rank lo .. lo+n go to
sequences from s on, q to a sequence, from an offset. Documents take their slots
by a join on length and a bucket of the rank. Ranks within a length are counted
along sorted ranges, so a length that a third of the corpus shares is ranked by
many tasks; full pieces are sequences of their own and need no rank.
"""

from __future__ import annotations

import bisect
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, write_table
from .scan import running

CAPACITY = 4096
END_ID = 1
CACHE_WORDS = 100_000           # of texts with unusual characters, per Python worker; the cache starts anew beyond it


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


#: words of ASCII letters and of the Latin-1 small letters need no normalising once A-Z is lower-cased
_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+").fullmatch
_caches: dict[str, dict[bytes, bytes]] = {}


def byte_letters() -> str:
    """The character that byte-level vocabularies write for each byte: printable ones stand for themselves."""
    plain = {b: chr(b) for b in range(256) if 33 <= b < 127 or 161 <= b and b != 173}
    other = iter(range(256, 512))
    return "".join(plain.get(b) or chr(next(other)) for b in range(256))


#: what the fast way can mark: lower-case letters by their capitals, punctuation by control characters
_LETTERS = bytes([*range(ord("a"), ord("z") + 1), *(c for c in range(0xDF, 0xFE) if c != 0xF7)])
_PUNCTUATION = b'.,!?;:"()-[]{}<>/\\@#$%&*+=_|'
_CONTROLS = bytes([*range(9), *range(14, 32), 127])
_MARK = np.arange(256, dtype=np.uint8)
_MARK[list(_LETTERS)] = [c - (32 if c < 128 else 31) for c in _LETTERS]
_MARK[list(_PUNCTUATION)] = list(_CONTROLS[:len(_PUNCTUATION)])
_CLASS = np.zeros(256, np.uint8)
_CLASS[list(_LETTERS)] = 1
_CLASS[list(b"0123456789")] = 2
_CLASS[list(_PUNCTUATION)] = 3
_plain_text = re.compile("[ \\t\\n\\r\\f\\va-zA-Z0-9ß-öø-ýÀ-ÖØ-Ý%s]*" % re.escape(_PUNCTUATION.decode())).fullmatch
_marked: dict[str, object] = {}


def marked_encoder(path: str):
    """text -> ids for texts of Latin-1 letters, digits and common punctuation, or None for another text.

    The vocabulary tells a word's last byte from the same byte inside a word.
    Here the last character of each run is replaced by one that can't occur
    otherwise, vectorised, which makes the vocabulary a plain byte-level one:
    a whole text is merged at once by ``tiktoken``, and no words are kept.
    """
    if path not in _marked:
        import tiktoken
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocabulary, suffix = model["vocab"], model["end_of_word_suffix"]
        made = [vocabulary["".join(m) if isinstance(m, list) else m.replace(" ", "", 1)] for m in model["merges"]]
        if any(x >= y for x, y in zip(made, made[1:])):
            raise ValueError("merges don't follow the order of ids")
        byte = {c: b for b, c in enumerate(byte_letters())}
        # of a two-byte letter only the second byte changes: 0xC3 0x9F..0xBD to 0xC3 0x80..0x9E
        last = {b: int(_MARK[b]) for b in range(128)} | {c - 64: c - 64 - 31 for c in _LETTERS if c > 128}
        inside = {b for b in range(128) if _CLASS[b] in (1, 3)} | {0xC3} | {c - 64 for c in _LETTERS if c > 128}
        ends = {b for b in range(128) if _CLASS[b]} | {c - 64 for c in _LETTERS if c > 128}
        ranks = {}
        for token, i in vocabulary.items():
            end = token.endswith(suffix)
            raw = [byte.get(c, -1) for c in (token[:-len(suffix)] if end else token)]
            if raw and inside.issuperset(raw[:-1]) and raw[-1] in (ends if end else inside):
                ranks[bytes(raw[:-1]) + bytes([last[raw[-1]] if end else raw[-1]])] = i
        runs = f"[a-zß-ý]*[A-ZÀ-Þ]|[0-9]|[{re.escape(_PUNCTUATION.decode())}]*[\x00-\x08\x0e-\x1f\x7f]"
        _marked[path] = tiktoken.Encoding("marked", pat_str=runs, mergeable_ranks=ranks, special_tokens={})
    encode = _marked[path].encode_to_numpy

    def ids(text: str) -> bytes | None:
        if "<|" in text or not _plain_text(text):
            return None
        raw = np.frombuffer(text.lower().encode("latin-1"), np.uint8)
        kind = _CLASS[raw]
        end = np.append(kind[1:] != kind[:-1], True) | (kind == 2) if len(raw) else np.zeros(0, bool)
        return encode(np.where(end, _MARK[raw], raw).tobytes().decode("latin-1"), disallowed_special=()) \
            .astype("<u4").tobytes()

    return ids


class WordTokens:
    """Token ids of texts: most by ``marked_encoder``, the others through a cache of words.

    This vocabulary drops white space and never joins across it, so the ids of
    a text are those of its white-space-separated words, which repeat a lot.
    New words of plain letters skip normalising and are merged many at a time;
    others go through the whole tokenizer; a full stop or comma after plain
    letters is a token of its own. Beyond ``size`` words the cache starts anew.
    """

    def __init__(self, path: str, size: int = CACHE_WORDS):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tok, self.size = Tokenizer.from_file(path), size
        self.letters = {b: c for b, c in enumerate(byte_letters()) if b != 32}
        self.merge = Tokenizer(self.tok.model)
        self.merge.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.tok.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)       # a word's last token
        for token, i in vocabulary.items():
            self.ends[i] = token.endswith("</w>")
        self.cache = _caches.setdefault(path, {})
        self.marked = marked_encoder(path)

    def learn(self, new: set[bytes]) -> None:
        cache, plain, stopped, other = self.cache, set(), [], []
        for w in new:
            low = w.lower()
            if _PLAIN(low):
                plain.add(low)
                if low != w:
                    stopped.append((w, low, b""))
            elif low[-1:] in (b".", b",") and _PLAIN(low[:-1]):
                plain.add(low[:-1])
                stopped.append((w, low[:-1], low[-1:]))
            else:
                other.append(w)
        other += [b".", b","]
        for w, e in zip(other, self.tok.encode_batch([w.decode() for w in other], add_special_tokens=False)):
            cache[w] = b"".join([i.to_bytes(4, "little") for i in e.ids])
        words = [w for w in plain if w not in cache]
        for lo in range(0, len(words), 2000):
            some = words[lo:lo + 2000]
            text = b" ".join(some).decode("latin-1").translate(self.letters)
            ids = np.array(self.merge.encode(text, add_special_tokens=False).ids, "<u4")
            cut = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
            if len(cut) != len(some):
                raise ValueError("the vocabulary doesn't mark the ends of words")
            raw, at = ids.tobytes(), 0
            for w, to in zip(some, cut):
                cache[w] = raw[at:to]
                at = to
        for w, word, stop in stopped:
            cache[w] = cache[word] + (cache[stop] if stop else b"")

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Token ids of each text as little-endian 32-bit integers."""
        found = [self.marked(t.decode()) for t in texts]
        other = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(other, self.by_word([texts[i] for i in other])):
            found[i] = ids
        return found

    def by_word(self, texts: list[bytes]) -> list[bytes]:
        split = [(t if b"<|" in t else t.lower()).split() for t in texts]     # special tokens are told by their case
        found = [list(map(self.cache.get, ws)) for ws in split]
        new = {w for ws, parts in zip(split, found) if None in parts
               for w, part in zip(ws, parts) if part is None}
        if not new:
            return [b"".join(parts) for parts in found]
        if len(self.cache) + len(new) > self.size:
            self.cache.clear()
            new.update(*split)
        self.learn(new)
        get = self.cache.__getitem__
        return [b"".join([get(w) if part is None else part for w, part in zip(ws, parts)] if None in parts else parts)
                for ws, parts in zip(split, found)]


def _pieces(batches, path: str, capacity: int, end_id: int) -> Iterator[pa.RecordBatch]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokens = WordTokens(path)
    tail, step = end_id.to_bytes(4, "little"), 4 * capacity
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        for lo in range(0, len(texts), 256):
            out = ([], [], [], [], [])
            ids = batch.column(0).slice(lo, 256).to_pylist()
            for doc, body in zip(ids, tokens.ids([t or b"" for t in texts.slice(lo, 256).to_pylist()])):
                body += tail
                for p, at in enumerate(range(0, len(body), step)):
                    piece = body[at:at + step]
                    for col, v in zip(out, (doc, p, at // 4, len(piece) // 4, zlib.crc32(piece))):
                        col.append(v)
            yield pa.record_batch([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()),
                                   *(pa.array(c, pa.int64()) for c in out[2:])],
                                  names=["id", "piece", "start", "length", "ids_crc32"])


def pieces(docs: DataFrame, id_col: str, text_col: str, path: str | None = None,
           capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(id, piece, start, length, ids_crc32): every text's ids and the end id, cut only beyond ``capacity``."""
    path = path or tokenizer_path()
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return map_arrow(base, lambda it: _pieces(it, path, capacity, end_id),
                     "id long, piece int, start long, length long, ids_crc32 long")


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit over counts, longest first: rows (length, first rank, pieces, first sequence, per sequence, offset).

    ``counts`` maps a length to its number of pieces. Equal open sequences are
    kept as one range, so the work depends on the number of lengths, not pieces.
    """
    rows, room = [], {}            # room left -> ranges (first sequence, number)
    rooms: list[int] = []          # sorted keys of ``room``
    used = 0

    def put(free: int, first: int, n: int) -> None:
        if free and n:
            if free not in room:
                bisect.insort(rooms, free)
                room[free] = []
            room[free].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                free = rooms[at]
                first, n = room[free].pop()
                if not room[free]:
                    del room[free], rooms[at]
            else:
                free, first = capacity, used
                n = -(-left // (capacity // length))
                used += n
            q = free // length
            whole = min(n, left // q)
            if whole:
                rows.append((length, rank, whole * q, first, q, capacity - free))
                put(free - q * length, first, whole)
                left, rank = left - whole * q, rank + whole * q
            if left and whole < n:
                rows.append((length, rank, left, first + whole, q, capacity - free))
                put(free - left * length, first + whole, 1)
                left, whole = 0, whole + 1
            put(free, first + whole, n - whole)
    return rows


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
         capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece.

    Every row of ``docs`` is packed: null and empty texts as the end id alone,
    repeated rows each on their own, a null id as any other. A text longer than
    ``capacity`` fills whole sequences and its last piece is packed. An empty
    table gives no rows. Only the two named columns are read.
    """
    cut = write_table(pieces(docs, id_col, text_col, path, capacity, end_id), "pieces")
    loose = cut.filter(F.col("length") < capacity)
    counts = dict(loose.groupBy("length").count().toLocalIterator())          # fewer than ``capacity`` rows
    rows = plan(counts, capacity)
    # a plan row serves ranks lo .. lo+n of a length: it is cut where buckets of ranks end, so that a
    # piece meets only the plan rows of its own bucket
    step = max(1, sum(counts.values()) // 4096)
    slots = [(length, b, max(lo, b * step), min(lo + n, (b + 1) * step), lo, first, per, place)
             for length, lo, n, first, per, place in rows for b in range(lo // step, (lo + n - 1) // step + 1)]
    slots = docs.sparkSession.createDataFrame(
        slots, "length long, bucket long, since long, until long, lo long, first long, per long, place long")
    ranked = running(loose.withColumn("one", F.lit(1).cast("long")), "length", ["id", "piece", "start", "ids_crc32"],
                     ["one"]).withColumnRenamed("before_one", "r").withColumn("bucket", F.expr(f"r div {step}"))
    # bounded by the lengths there are and the 4,096 buckets of ranks, not by the corpus
    placed = ranked.join(F.broadcast(slots), ["length", "bucket"]).filter("r >= since and r < until")
    k = F.col("r") - F.col("lo")
    used = max((first + -(-n // per) for _, _, n, first, per, _ in rows), default=0)
    cols = ["id", "piece", "start", "length", "ids_crc32"]
    full = cut.filter(F.col("length") == capacity).select(
        *cols, (F.monotonically_increasing_id() + used).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return full.unionByName(placed.select(
        *cols, (F.col("first") + F.expr("(r - lo) div per")).alias("sequence_id"),
        (F.col("place") + F.pmod(k, F.col("per")) * F.col("length")).alias("offset")))
