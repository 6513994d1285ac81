"""Prefix trie of conversations by block hashing.

A conversation's turns are cut into blocks of a fixed number of turns, and each
block gets the digest of the whole prefix it ends. Conversations are grouped by
these block digests first. Only blocks in which the conversations of a group
part are looked at turn by turn; elsewhere the block's turns are nodes as they are.

A node is known by its depth and its smallest member, its owner. A conversation
owns its path from some depth on (``k``) or nowhere, so what a subtree gathers
is a sum over members, and needs no walk up the tree:

- leaves: members whose own last node has no child;
- saved bytes: a member saves the turns from the node's on up to depth k - 1,
  which another one holds for it.

The prefix digest is the sum, modulo 2**56 in each of two lanes, of SHA-256
digests of (position, role, text). Sums of earlier blocks can be taken in parallel
(``scan.running``), so a conversation of any length spreads over many tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, write_table
from .scan import MASK, running

BLOCK = 4
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
CHUNK = 1 << 14                      # ids that one row of the joined lists holds


def digests(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """(c, turn, digest, nbytes): turns without their texts; null roles and texts are empty, null conversations go."""
    r, t = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    told = F.concat(F.octet_length(r).cast("string"), F.lit(":"), r, t)        # no two turns give the same string
    return rows.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("c"), F.col(turn).alias("turn"), F.sha2(told, 256).alias("digest"),
        F.octet_length(t).cast("long").alias("nbytes"))


def ranked(turns: DataFrame) -> DataFrame:
    """(c, pos, digest, nbytes): turns numbered from 0 by turn, null first; of equal turns the smaller digest first."""
    found = running(turns.withColumn("one", F.lit(1).cast("long")), "c", [F.col("turn").asc_nulls_first(), "digest"],
                    ["one"])
    return found.select("c", F.col("before_one").alias("pos"), "digest", "nbytes")


def _masked(c: Column) -> Column:
    return c.bitwiseAND(F.lit(MASK))


def _blocks(turns: DataFrame, block: int) -> DataFrame:
    """A row per conversation and block: its turns with prefix digests, the digest before and behind it."""
    told = F.sha2(F.concat(F.col("pos").cast("string"), F.lit(":"), F.col("digest")), 256)
    lane = lambda at: F.conv(F.substring(told, at, 14), 16, 10).cast("long")
    entry = F.struct("pos", lane(1).alias("a"), lane(15).alias("b"), F.col("nbytes"))
    # at most ``block`` entries a group
    cut = turns.select("c", F.floor(F.col("pos") / block).alias("j"), entry.alias("e")) \
        .groupBy("c", "j").agg(F.sort_array(F.collect_list("e")).alias("e"),
                               _masked(F.sum("e.a")).alias("a"), _masked(F.sum("e.b")).alias("b"),
                               F.sum("e.nbytes").alias("nbytes"))
    found = running(cut, "c", ["j"], ["a", "b", "nbytes"])

    def upto(field: str, n: Column) -> Column:
        return F.aggregate(F.slice("e", F.lit(1), n), F.col(f"before_{field}"), lambda s, x: s + x[field])

    cumulated = F.transform("e", lambda x, i: F.struct(
        (x["pos"] + 1).alias("depth"), _masked(upto("a", i + 1)).alias("a"), _masked(upto("b", i + 1)).alias("b"),
        _masked(upto("a", i)).alias("pa"), _masked(upto("b", i)).alias("pb"), upto("nbytes", i).alias("upto"),
        x["nbytes"].alias("nbytes")))
    return found.select("c", "j", F.size("e").alias("len"), F.col("before_a").alias("sa"), F.col("before_b").alias("sb"),
                        _masked(F.col("before_a") + F.col("a")).alias("ea"),
                        _masked(F.col("before_b") + F.col("b")).alias("eb"),
                        (F.col("before_nbytes") + F.col("nbytes")).alias("total"), cumulated.alias("e"))


def _chunks(batches) -> Iterator[pa.RecordBatch]:
    """Runs of (owner, depth) in sorted rows become comma-joined ids, at most CHUNK to a row."""
    key, first, ids = None, 0, []

    def row():
        return pa.record_batch([pa.array([key[0]]), pa.array([key[1]]), pa.array([first]),
                                pa.array([",".join(map(str, ids))])], names=["owner", "depth", "first", "ids"])

    for batch in batches:
        for owner, depth, c in zip(*(col.to_pylist() for col in batch.columns)):
            if (owner, depth) != key or len(ids) == CHUNK:
                if ids:
                    yield row()
                key, first, ids = (owner, depth), c, []
            ids.append(c)
    if ids:
        yield row()


def _hashed(batches) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined ids of each (owner, depth), chunk by chunk."""
    key, sha, out = None, None, []

    def done():
        return pa.record_batch([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
                                pa.array([x[2] for x in out], pa.string())], names=["owner", "depth", "sha"])

    for batch in batches:
        for owner, depth, _, ids in zip(*(col.to_pylist() for col in batch.columns)):
            if (owner, depth) != key:
                if key is not None:
                    out.append((*key, sha.hexdigest()))
                key, sha = (owner, depth), hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        yield done()
        out = []
    if key is not None:
        out.append((*key, sha.hexdigest()))
        yield done()


def ends_digests(ends: DataFrame) -> DataFrame:
    """(owner, depth, sha): SHA-256 of the ascending ids c, comma-joined, of rows (owner, depth, c).

    A digest is sequential, but sorting and writing out the ids is not: they
    are dealt out by ranges of (owner, depth, c), and only the joined lists, a
    row for 16,384 ids, meet in the task that hashes them one after another.
    """
    lists = map_arrow(ends.select("owner", "depth", "c").repartitionByRange("owner", "depth", "c")
                      .sortWithinPartitions("owner", "depth", "c"), _chunks,
                      "owner long, depth long, first long, ids string")
    return map_arrow(lists.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "first"), _hashed,
                     "owner long, depth long, sha string")


def trie(turns: DataFrame, convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The trie's nodes from (c, pos, digest, nbytes), pos counting from 0 in each c, and all conversations (c).

    See ``prefix_trie`` for the columns.
    """
    here = write_table(_blocks(turns, block), "blocks")
    content = ["j", "len", "ea", "eb"]
    groups = here.groupBy(*content).agg(F.count("*").alias("n"), F.min("c").alias("owner"),
                                        F.first(F.struct("sa", "sb", "e")).alias("x"))
    groups = write_table(groups.select(*content, "n", "owner", "x.sa", "x.sb", "x.e"), "contents")
    # a prefix parts within its next block where more than one content follows
    parting = groups.groupBy("j", "sa", "sb").agg((F.count("*") > 1).alias("parts"))
    groups = write_table(groups.join(parting, ["j", "sa", "sb"]), "contents")

    def nodes_of(rows: DataFrame, sums: list[str]) -> DataFrame:
        """Turn rows as nodes: those of parting blocks are grouped by digest, the others are nodes already."""
        cols = ["depth", "a", "b", "pa", "pb", "upto"]
        whole = rows.filter("not parts").select(*cols, "owner", "n", *sums)
        split = rows.filter("parts").groupBy(*cols).agg(F.min("owner").alias("owner"), F.sum("n").alias("n"),
                                                        *(F.sum(s).alias(s) for s in sums))
        return whole.unionByName(split)

    turn_rows = groups.select("parts", "owner", "n", F.explode("e").alias("e")).select("parts", "owner", "n", "e.*")
    nodes = write_table(nodes_of(turn_rows, []), "nodes")

    least = F.lit(convs.agg(F.min("c")).first()[0]).cast("long")                    # the root's owner
    # where an owner's path begins, and the node it begins below
    starts = nodes.groupBy("owner").agg(F.min(F.struct("depth", "pa", "pb", "upto")).alias("s")) \
        .select("owner", F.col("s.depth").alias("k"), "s.pa", "s.pb", F.col("s.upto").alias("held"))
    above = nodes.select((F.col("depth") + 1).alias("k"), F.col("a").alias("pa"), F.col("b").alias("pb"),
                         F.col("owner").alias("above"))
    starts = write_table(starts.join(above, ["k", "pa", "pb"], "left")
                         .withColumn("above", F.when(F.col("k") == 1, least).otherwise(F.col("above")))
                         .drop("pa", "pb"), "starts")
    branches = write_table(starts.filter("owner <> above")
                           .groupBy(F.col("above").alias("owner"), (F.col("k") - 1).alias("depth"))
                           .agg(F.count("*").alias("branches")), "branches")

    last = here.groupBy("c").agg(F.max(F.struct((F.col("j") * block + F.col("len")).alias("last"),
                                                "ea", "eb", "total")).alias("z")).select("c", "z.*")
    stats = convs.join(last, "c", "left").join(starts.withColumnRenamed("owner", "c"), "c", "left") \
        .fillna(0, ["last", "ea", "eb", "total"])
    owns = F.col("k").isNotNull()
    stats = stats.join(branches.select(F.col("owner").alias("c"), F.col("depth").alias("last"), "branches"),
                       ["c", "last"], "left") \
        .withColumn("leaf", (owns & F.col("branches").isNull()).cast("long")) \
        .withColumn("held", F.coalesce("held", "total")).withColumn("from", F.coalesce("k", F.col("last") + 1))
    stats = write_table(stats.select("c", "last", "ea", "eb", "k", "above", "from", "held", "leaf"), "conversations")

    # what the members of each block content add to its nodes; only the smallest can own a part of it
    behind = F.col("from") > F.col("j") * block + F.col("len")
    added = here.select("c", *content).join(stats.select("c", "from", "held", "leaf"), "c").groupBy(*content).agg(
        F.sum("leaf").alias("leaves"), F.sum(behind.cast("long")).alias("others"),
        F.sum(F.when(behind, F.col("held")).otherwise(0)).alias("held"),
        F.max(F.when(~behind, F.struct("from", F.col("held").alias("upto")))).alias("own"))
    turn_rows = groups.join(added, content).select("parts", "owner", "n", "leaves", "others", "held", "own",
                                                   F.explode("e").alias("e")) \
        .select("parts", "owner", "n", "leaves", "others", "held", "own", "e.*")
    mine = F.when(F.col("own.from") > F.col("depth"), F.col("own.upto") - F.col("upto")).otherwise(0)
    turn_rows = turn_rows.withColumn("saved", F.col("held") - F.col("others") * F.col("upto") + mine)
    full = nodes_of(turn_rows, ["leaves", "saved"]).select("depth", "owner", "n", "leaves", "saved")

    # the root: all conversations are its members
    alone = F.when(F.sum("last") == 0, 1).otherwise(F.sum("leaf"))
    root = stats.agg(F.min("c").alias("owner"), F.count("*").alias("n"), alone.alias("leaves"),
                     F.sum("held").alias("saved")).filter("n > 0") \
        .select(F.lit(0).cast("long").alias("depth"), "owner", "n", "leaves", "saved")
    full = full.withColumn("depth", F.col("depth").cast("long")).unionByName(root)

    # conversations that end at a node: their own one, or that of the smallest equal conversation
    kept = stats.filter("k is not null").select(F.col("c").alias("owner"), F.col("last").alias("depth"), "c")
    copies = stats.filter("k is null and last > 0").select("c", F.col("last").alias("depth"), "ea", "eb")
    spots = nodes.select("depth", F.col("a").alias("ea"), F.col("b").alias("eb"), "owner")
    copies = copies.join(spots, ["depth", "ea", "eb"]).select("owner", "depth", "c")
    bare = stats.filter("last = 0").select(least.alias("owner"), F.col("last").alias("depth"), "c")
    ended = ends_digests(kept.unionByName(copies).unionByName(bare))

    paths = stats.select(F.col("c").alias("owner"), "k", "above", "last")
    marked = full.join(paths, "owner").join(branches, ["owner", "depth"], "left").join(ended, ["owner", "depth"], "left")
    go_on = (F.col("depth") < F.col("last")).cast("long")
    return marked.select(
        F.col("owner").alias("conv_id"), "depth",
        F.when(F.col("depth") == F.col("k"), F.col("above")).when(F.col("depth") > 0, F.col("owner"))
        .alias("parent_conv_id"),
        F.col("n").alias("n_convs"), (go_on + F.coalesce("branches", F.lit(0))).alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("sha", F.lit(EMPTY_SHA)).alias("ends_sha256"))


def prefix_trie(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                block: int = BLOCK) -> DataFrame:
    """The prefix trie of the conversations in ``rows``, a row per node.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256): smallest member; number of turns; the parent's conv_id (null at the
    root); members; children; childless nodes of the subtree; the subtree's sum of
    (members - 1) times the bytes of a node's last text; SHA-256 of the members that
    end here, in ascending order, comma-joined.

    Null roles and texts count as empty, rows with a null conversation are left
    out. Turns are taken in order of ``turn``, null first; turns that tie (or
    repeat) all stay, ordered by the SHA-256 of role and text. An empty table
    gives no rows, and other columns are not read.
    """
    turns = write_table(ranked(digests(rows, conv, turn, role, text)), "turns")
    return trie(turns, turns.select("c").distinct(), block)


def regrafted(turns: DataFrame, every: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that share beginnings, made from (c, pos, digest, nbytes): (their turns, their ids).

    Conversation c begins with the first h turns of conversation c - c % every
    (fewer, if it has fewer) and goes on with its own after its first h, where
    h is crc32 of c in decimal, modulo ``most``.
    """
    h = (F.crc32(F.col("c").cast("string").cast("binary")) % most).alias("h")
    heads = turns.filter((F.col("pos") < most - 1) & (F.col("c") % every == 0)) \
        .groupBy(F.col("c").alias("base")).agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "nbytes"))).alias("e"))
    convs = turns.select("c").distinct().select("c", h, (F.col("c") - F.col("c") % every).alias("base")) \
        .join(heads, "base", "left")
    convs = write_table(convs.select("c", "h", F.when(F.col("h") > 0, F.slice("e", F.lit(1), F.col("h").cast("int")))
                                     .alias("e")), "grafts")
    first = convs.select("c", F.explode("e").alias("e")).select("c", "e.*")
    taken = F.coalesce(F.size("e"), F.lit(0))
    taken = F.when(F.col("e").isNull(), 0).otherwise(taken)
    own = turns.join(convs, "c").filter("pos >= h") \
        .select("c", (F.col("pos") - F.col("h") + taken).alias("pos"), "digest", "nbytes")
    return first.unionByName(own), convs.select("c")
