"""Line dedup with a fixed-depth log-template tree.

A line's leaf is its token count and leading tokens; tokens with a digit are
variable fields from the start. Inside a leaf, a token that stands at its place
in at least ``least`` different documents is fixed, any other is a variable
field; the fixed tokens are the line's template. Documents that are copies or
near copies of each other (one family, see ``families``) count once and are left to
document dedup, while a line pasted into many documents counts each time,
whatever stands around it. Templates with ``least`` documents recur; their lines
go from every document but the first that has them. A line of many tokens can't
coincide by chance: a line in no such template recurs with ``least_long``
documents, if so many fix at least ``long_tokens`` of its tokens.

All of it is grouped counts and joins, so a leaf that a third of the corpus
shares is counted by many tasks. Only leaves with enough documents are looked at
token by token: their slots come to the driver as a bitmap of fixed size, and
slots hit by chance are removed by an exact join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import _MULT, chunks, map_arrow, mix, only_marked, shingle_hashes, text_buffers, words, write_table

LEAST = 6                      # documents that make a template recur
DEPTH = 3                      # leading tokens of a leaf
LEAST_LONG = 2                 # the same for a template of many fixed tokens
LONG_TOKENS = 20               # so many fixed tokens are many
FIXED_SHARE = 0.6              # least share of fixed tokens in a template
LEAST_TOKENS = 3               # shorter lines are left alone
SLOT_BITS = 23
SALTS = 16
BINS = 64                      # of a document's sketch, 16 bits each
BAND = 4                       # bins that two documents must share to be compared
ALIKE = 0.8                    # least share of equal bins in a family
SHINGLE = 3                    # tokens of a sketched shingle
_FIELD = np.uint64(0x9E3779B97F4A7C15)
_DIGIT = np.zeros(256, np.int32)
_DIGIT[48:58] = 1


def parse(raw: np.ndarray, offsets: np.ndarray, depth: int) -> tuple:
    """Lines of texts that hold tokens, in order.

    (document, line number, first token, tokens, leaf, whole line), the token
    hashes with variable fields masked and, per document, the index of its first token.
    """
    h, starts, ends, begin = words(raw, offsets)
    digits = np.concatenate([[0], np.cumsum(_DIGIT[raw])])
    h = np.where(digits[ends] > digits[starts], _FIELD, h)
    breaks = np.flatnonzero(raw == 10)
    doc = np.searchsorted(offsets, starts, "right") - 1
    line = np.searchsorted(breaks, starts) - np.searchsorted(breaks, offsets[:-1])[doc]
    new = np.ones(len(h), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (line[1:] != line[:-1])
    first = np.flatnonzero(new)
    if not len(first):
        z = np.zeros(0, np.int64)
        return z, z, z, z, h[:0], h[:0], h, begin
    n = np.diff(np.append(first, len(h)))
    leaf = mix(n.astype(np.uint64))
    for i in range(depth):
        tok = np.where(n > i, h[np.minimum(first + i, len(h) - 1)], np.uint64(0))
        leaf = mix(leaf + tok * _MULT[i])
    place = (np.arange(len(h)) - np.repeat(first, n)).astype(np.uint64)
    whole = mix(np.add.reduceat(mix(h + place * _MULT[9]), first) + leaf)
    return doc[first], line[first], first, n, leaf, whole, h, begin


def sketches(h: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Per document BINS least shingle hashes, one for each range of hashes, cut to 16 bits; 65535 in an empty range."""
    docs = len(begin) - 1
    out = np.full(docs * BINS, np.iinfo(np.uint64).max, np.uint64)
    sh = shingle_hashes(h, SHINGLE)
    doc = np.repeat(np.arange(docs), np.diff(begin))[:len(sh)]
    inside = np.arange(len(sh)) + SHINGLE <= begin[1:][doc]
    sh, doc = sh[inside], doc[inside]
    bits = BINS.bit_length() - 1
    np.minimum.at(out, doc * BINS + (sh >> np.uint64(64 - bits)).astype(np.int64), sh & np.uint64((1 << 64 - bits) - 1))
    return (out & np.uint64(0xFFFF)).astype(np.uint16).reshape(docs, BINS)


def _lines(batches, depth: int, least_tokens: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_buffers(batch.column(2))
        for i, j, raw, off in chunks(data, offsets):
            doc, line, _, n, leaf, whole, h, begin = parse(raw, off, depth)
            keep = n >= least_tokens
            doc_of = doc[keep]
            at = pa.array(i + doc_of)
            told = [row.tobytes() for row in sketches(h, begin)]
            lead = np.append(True, doc_of[1:] != doc_of[:-1])[:len(doc_of)]     # a sketch is on its text's first line
            yield pa.record_batch(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(line[keep], pa.int32()),
                 pa.array(n[keep], pa.int32()),
                 *(pa.array(c[keep].view(np.int64)) for c in (leaf, whole)),
                 pa.array([told[d] if x else None for d, x in zip(doc_of, lead)], pa.binary())],
                names=["id", "version", "line", "tokens", "leaf", "whole", "sketch"])


def _tokens(batches, depth: int, least_tokens: int, slots: bytes) -> Iterator[pa.RecordBatch]:
    """Distinct lines of a batch in the marked slots, with their tokens; a variable field is null."""
    marked = np.unpackbits(np.frombuffer(slots, np.uint8), bitorder="little").astype(bool)
    mask = np.uint64((1 << SLOT_BITS) - 1)
    for batch in batches:
        data, offsets = text_buffers(batch.column(0))
        for _, _, raw, off in chunks(data, offsets):
            _, _, first, n, leaf, whole, h, _ = parse(raw, off, depth)
            keep = np.flatnonzero((n >= least_tokens) & marked[leaf & mask])
            keep = keep[np.unique(whole[keep], return_index=True)[1]]
            n = n[keep]
            flat = h[np.repeat(first[keep], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            yield pa.record_batch(
                [pa.array(leaf[keep].view(np.int64)), pa.array(whole[keep].view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)), pa.int32()),
                                          pa.array(flat.view(np.int64), mask=flat == _FIELD))],
                names=["leaf", "whole", "tokens"])


def _slots(leaves: DataFrame) -> bytes:
    """Bitmap of the leaves' slots: 2**SLOT_BITS bits, however many leaves."""
    bit = F.expr(f"leaf & {(1 << SLOT_BITS) - 1}L") + 1
    parts = leaves.groupBy(F.bitmap_bucket_number(bit).alias("k")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).collect()
    out = bytearray(1 << (SLOT_BITS - 3))
    for r in parts:
        at = (r["k"] - 1) * 4096
        out[at:at + len(r["bits"])] = r["bits"]
    return bytes(out)


def _grouped(lines: DataFrame, family: DataFrame) -> DataFrame:
    """``lines`` with their document's group: its family's, or itself; only lines of families are shuffled."""
    member = family.select("id")
    alone = only_marked(lines, "id", member, "left_anti").withColumn("group", F.col("id"))
    return alone.unionByName(only_marked(lines, "id", member).join(family, "id", "left")
                             .withColumn("group", F.coalesce("group", "id")))


def _alike(batches) -> Iterator[pa.RecordBatch]:
    """(id, centre) of the pairs whose sketches agree in ALIKE of the bins that either fills."""
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, BINS) for c in ("a", "b"))
        filled = ((a != 0xFFFF) | (b != 0xFFFF)).sum(1)
        same = ((a == b) & (a != 0xFFFF)).sum(1)
        yield batch.select(["id", "centre"]).filter(pa.array(same >= ALIKE * filled))


def families(sketched: DataFrame) -> DataFrame:
    """(id, group) for documents (id, sketch) that are copies or near copies of a smaller id.

    Equal sketches are grouped first. Of the rest, documents that share a band
    of bins are compared with the smallest of that band by their sketches, and
    join the smallest they agree with, or the one that has joined itself.
    """
    equal = sketched.groupBy("sketch").agg(F.min("id").alias("id"), F.max("id").alias("most"))
    reps = write_table(equal.select("id", "sketch", "most"), "sketches")
    copies = sketched.join(reps.filter("id < most").select("sketch", F.col("id").alias("rep")), "sketch") \
        .filter("id > rep").select("id", "rep")
    width = 2 * BAND
    at = F.explode(F.sequence(F.lit(0), F.lit(BINS // BAND - 1)))
    band = reps.select("id", "sketch", at.alias("k")) \
        .select("id", "k", F.substring("sketch", F.col("k") * width + 1, F.lit(width)).alias("bins")) \
        .filter(F.col("bins") != F.lit(b"\xff" * width)).select("id", F.xxhash64("k", "bins").alias("key"))
    shared = write_table(band.groupBy("key").agg(F.min("id").alias("centre"), F.max("id").alias("most"))
                         .filter("centre < most").select("key", "centre"), "bands")
    pairs = only_marked(band, "key", shared.select("key")).join(shared, "key").filter("id > centre") \
        .select("id", "centre").distinct()
    of = reps.select("id", F.col("sketch").alias("a"))
    compared = pairs.join(of, "id").join(of.select(F.col("id").alias("centre"), F.col("a").alias("b")), "centre")
    near = write_table(map_arrow(compared.select("id", "centre", "a", "b"), _alike, "id long, centre long")
                       .groupBy("id").agg(F.min("centre").alias("group")), "near")
    up = near.select(F.col("id").alias("group"), F.col("group").alias("up"))
    near = near.join(up, "group", "left").select("id", F.coalesce("up", "group").alias("group"))
    of_copy = copies.join(near.select(F.col("id").alias("rep"), "group"), "rep", "left") \
        .select("id", F.coalesce("group", "rep").alias("group"))
    return near.unionByName(of_copy).groupBy("id").agg(F.min("group").alias("group"))


def recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
                    depth: int = DEPTH, fixed_share: float = FIXED_SHARE,
                    least_tokens: int = LEAST_TOKENS, least_long: int = LEAST_LONG,
                    long_tokens: int = LONG_TOKENS) -> DataFrame:
    """(id, version, line, template): every line of a recurring template outside the first document with it.

    version is xxhash64 of the text, so rows that repeat an id are told apart
    and equal rows get the same lines; line counts from 0. The first document
    is that with the smallest id. Lines end at newline characters; tokens are
    split at ASCII white space and compared with A-Z lower-cased. Lines of
    fewer than ``least_tokens`` tokens, null and empty texts and rows with a
    null id yield nothing, as does an empty table. Only the two named columns
    are read.
    """
    base = docs.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()) \
        .select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("version"),
                F.col(text_col).alias("text"))
    lines = write_table(map_arrow(
        base, lambda it: _lines(it, depth, least_tokens),
        "id long, version long, line int, tokens int, leaf long, whole long, sketch binary"), "lines")
    family = write_table(families(lines.filter("sketch is not null").select("id", "sketch")), "families")
    # a leaf of one family can't recur, and most leaves are such: a bitmap prunes their lines
    grouped = _grouped(lines.drop("sketch"), family)
    shared = write_table(grouped.groupBy("leaf").agg(F.min("group").alias("lo"), F.max("group").alias("hi"))
                         .filter("lo < hi").select("leaf"), "shared")
    lines = write_table(_grouped(only_marked(lines.drop("sketch"), "leaf", shared), family), "grouped")
    enough = (F.col("n") >= least) | ((F.col("tokens") >= long_tokens) & (F.col("n") >= least_long))
    leaves = write_table(lines.groupBy("leaf").agg(F.count_distinct("group").alias("n"), F.max("tokens").alias("tokens"))
                         .filter(enough).select("leaf"), "leaves")
    slots = _slots(leaves)
    distinct = map_arrow(
        base.select("text"), lambda it: _tokens(it, depth, least_tokens, slots),
        "leaf long, whole long, tokens array<long>") \
        .join(leaves, "leaf", "left_semi").groupBy("leaf", "whole").agg(F.first("tokens").alias("tokens"))
    distinct = write_table(distinct, "distinct")

    # so many documents of a line are as many as any test below needs
    most = max(least, least_long)
    some = Window.partitionBy("leaf", "whole").orderBy("group")
    seen = only_marked(lines, "leaf", leaves).select("leaf", "whole", "group").distinct() \
        .withColumn("r", F.row_number().over(some)).filter(F.col("r") <= most)
    seen = write_table(seen.groupBy("leaf", "whole").agg(F.collect_list("group").alias("groups")), "groups")
    template = _recurring(distinct, seen, least, least_long, fixed_share, long_tokens)
    found = write_table(only_marked(lines, "leaf", leaves).join(template, ["leaf", "whole"])
                        .select("id", "version", "line", "template"), "recurring")
    # a template's lines meet its first document in SALTS places, as a common one has many lines
    first = found.groupBy("template").agg(F.min("id").alias("first")) \
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return found.withColumn("salt", F.pmod(F.col("id"), F.lit(SALTS)).cast("int")).join(first, ["template", "salt"]) \
        .filter(F.col("id") > F.col("first")).select("id", "version", "line", "template")


def _recurring(distinct: DataFrame, seen: DataFrame, least: int, least_long: int, fixed_share: float,
               long_tokens: int) -> DataFrame:
    """(leaf, whole, template): lines whose template recurs, with ``least`` documents or, being long, ``least_long``.

    A token's documents are counted once for both. A line has two templates: of
    the tokens that ``least`` documents fix and of those that ``least_long`` do;
    the first counts where it recurs.
    """
    token = distinct.select("leaf", "whole", F.posexplode("tokens").alias("i", "token"))
    # lines meet their documents before they are taken apart, so tokens are shuffled once
    held = distinct.join(seen, ["leaf", "whole"]).select("leaf", "groups", F.posexplode("tokens").alias("i", "token")) \
        .filter("token is not null").select("leaf", "i", "token", F.explode("groups").alias("group")) \
        .groupBy("leaf", "i", "token").agg(F.count_distinct("group").alias("n")) \
        .filter(F.col("n") >= min(least, least_long))

    def told(k: int, name: str) -> list:
        fixed = F.coalesce(F.col("n") >= k, F.lit(False))
        return [F.bit_xor(F.xxhash64("leaf", "i", F.when(fixed, F.col("token")), fixed)).alias(name),
                F.count_if(fixed).alias(f"{name}_kept")]

    lines = token.join(held, ["leaf", "i", "token"], "left").groupBy("leaf", "whole").agg(
        *told(least, "often"), *told(least_long, "long"), F.count("*").alias("size"))
    share = lambda name: F.col(f"{name}_kept") >= fixed_share * F.col("size")
    lines = lines.select(
        "leaf", "whole", F.when(share("often"), F.col("often")).alias("often"),
        F.when(share("long") & (F.col("long_kept") >= long_tokens), F.col("long")).alias("long"))
    lines = write_table(lines.filter("often is not null or long is not null"), "templates")

    def recurring(name: str, k: int) -> DataFrame:
        return lines.filter(F.col(name).isNotNull()).join(seen, ["leaf", "whole"]) \
            .select(name, F.explode("groups").alias("group")).groupBy(name) \
            .agg(F.count_distinct("group").alias("n")).filter(F.col("n") >= k) \
            .select(name, F.lit(True).alias(f"is_{name}"))

    kept = lines.join(recurring("often", least), "often", "left").join(recurring("long", least_long), "long", "left")
    return kept.select("leaf", "whole", F.when(F.col("is_often"), F.col("often"))
                       .when(F.col("is_long"), F.col("long")).alias("template")).filter("template is not null")


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """(id, n_lines, n_dropped, dropped) per row: dropped line numbers, ascending and comma-joined.

    A null text has no lines, an empty one has one; rows that repeat an id with
    one text each get the same answer.
    """
    gone = _dropped(recurring_lines(docs, id_col, text_col, **how))
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("version"),
                       F.when(F.col(text_col).isNull(), 0).otherwise(F.size(F.split(text_col, "\n")))
                       .cast("long").alias("n_lines"))
    return base.join(gone, ["id", "version"], "left").select(
        "id", "n_lines", F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce(F.array_join(F.col("gone").cast("array<string>"), ","), F.lit("")).alias("dropped"))


def _dropped(found: DataFrame) -> DataFrame:
    return found.groupBy("id", "version").agg(F.array_sort(F.collect_set("line")).alias("gone"))


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with the recurring lines cut out of their texts; rows left without a word go.

    All columns and other rows stay as they are, null and empty texts included.
    """
    gone = _dropped(recurring_lines(docs, id_col, text_col, **how)) \
        .select(F.col("id").alias("__id"), F.col("version").alias("__version"), F.col("gone").alias("__gone"))
    on = (F.col(f"`{id_col}`").cast("long") == F.col("__id")) & (F.xxhash64(F.col(f"`{text_col}`")) == F.col("__version"))
    rest = F.array_join(F.filter(F.split(f"`{text_col}`", "\n"), lambda x, i: ~F.array_contains("__gone", i)), "\n")
    cut = docs.join(gone, on, "left").withColumn(
        text_col, F.when(F.col("__gone").isNull(), F.col(f"`{text_col}`")).otherwise(rest))
    return cut.filter(F.col("__gone").isNull() | F.col(f"`{text_col}`").rlike(r"\S")).select(
        *(F.col(f"`{c}`") for c in docs.columns))
