"""The numbered queries: each reads its whole table and derives its contract columns from an operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, convtrie, decontam, langid, licenses, linededup, minhash, packing, quality, secrets, slackpack, warc,
               whitening)
from .common import load, write_table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of ``documents`` on 4-word shingles at similarity 0.8."""
    found = minhash.near_duplicates(load(spark, sf_dir, "documents"), "doc_id", "text", k=4, percent=80)
    return found.withColumnRenamed("id", "doc_id")


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ORACLES["op1_minhash_near_dedup"] = f"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
                                    '[^\\x20\\x09-\\x0D]+') ws from documents),
s as (select distinct doc_id, unnest(
        case when len(ws) >= 4 then [array_to_string(ws[i:i+3], ' ') for i in range(1, len(ws) - 2)]
             when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) g from w),
n as (select doc_id, count(*) n from s group by 1),
p as (select a.doc_id x, b.doc_id y, count(*) c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
e as (select x, y from p join n a on a.doc_id = x join n b on b.doc_id = y where 100 * c >= 80 * (a.n + b.n - c)),
u as (select x, y from e union all select y, x from e),
r(d, m) as (select doc_id, doc_id from documents union select u.y, r.m from r join u on r.d = u.x),
c as (select d doc_id, min(m) component_id from r group by 1)
select doc_id, coalesce(n, 0) n_shingles, component_id, doc_id = component_id kept
from documents left join n using (doc_id) join c using (doc_id)"""


@query
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of at most 4096 tokens."""
    return packing.pack(load(spark, sf_dir, "documents"), "doc_id", "text").withColumnRenamed("id", "doc_id")


@query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and templates in all ``documents``."""
    return licenses.scan_licenses(load(spark, sf_dir, "documents"), "doc_id", "text") \
        .withColumnRenamed("id", "doc_id")


@query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``pages`` written as WARC records, read back and indexed."""
    return warc.capture_index(load(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op9_warc"] = """
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, strlen(html) as payload_bytes, sha1(html) as payload_digest from p),
m as (select payload_digest, max(page_id) as last from d where payload_bytes >= 1000 group by 1)
select page_id, payload_bytes, payload_digest,
       case when last is not null and last <> page_id then 'revisit' else 'response' end as record_type,
       case when last <> page_id then last end as refers_to
from d left join m using (payload_digest)"""


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text of ``documents``."""
    return langid.identify(load(spark, sf_dir, "documents"), "doc_id", "text", "lang") \
        .withColumnRenamed("id", "doc_id")


@query
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of ``benchmark`` that stand in ``documents``, within a fifth of their words in edits."""
    return decontam.contaminated(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark")) \
        .withColumnRenamed("id", "doc_id")


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of recurring templates in ``documents``."""
    return linededup.line_report(load(spark, sf_dir, "documents"), "doc_id", "text") \
        .withColumnRenamed("id", "doc_id")


@query
def op2_multi_index_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest neighbours by cosine of every 50th vector of ``embeddings``."""
    return ann.search(load(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0) \
        .withColumnRenamed("id", "vec_id")


@query
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality and abuse scores of all ``documents``, from weak labels."""
    return quality.classify(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")) \
        .withColumnRenamed("id", "doc_id")


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all ``documents``: base patterns and Markov models."""
    return secrets.secret_report(load(spark, sf_dir, "documents"), "doc_id", "text") \
        .withColumnRenamed("id", "doc_id")


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first eight whitened components of all ``embeddings``; deviations beyond a long are null."""
    return whitening.whiten(load(spark, sf_dir, "embeddings"), "vec_id", "embedding") \
        .withColumn("deviation", F.expr("try_cast(deviation as bigint)")).withColumnRenamed("id", "vec_id")


@query
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of all ``conversations``, each begun with turns of every fifth one."""
    turns = write_table(convtrie.ranked(convtrie.digests(load(spark, sf_dir, "conversations"))), "turns")
    return convtrie.trie(*convtrie.regrafted(turns))


# crc32, bit by bit: DuckDB has no function for it
ORACLES["op12_conversation_trie"] = f"""
with t as (
  select conv_id c, coalesce(role, '') r, coalesce(text, '') x,
         row_number() over (partition by conv_id order by turn nulls first,
           sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 pos
  from conversations where conv_id is not null),
own as (select c, list({{'r': r, 'x': x}} order by pos) turns from t group by c),
hashed as (select c, turns, c - c % 5 base, xor(4294967295, list_reduce(
    list_prepend(4294967295::bigint, [ascii(ch)::bigint for ch in string_split(c::varchar, '')]),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
      lambda v, i: case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end))) % 9 h from own),
re as (select a.c, list_concat(coalesce(b.turns, [])[1:a.h], a.turns[a.h + 1:]) turns
       from hashed a left join own b on b.c = a.base),
m as (select c, d, sha256(turns[1:d]::varchar || d) node,
             case when d > 0 then sha256(turns[1:d - 1]::varchar || (d - 1)) end parent,
             case when d > 0 then strlen(turns[d].x) else 0 end nbytes, d = len(turns) ends
      from (select c, turns, unnest(range(0, len(turns) + 1)) d from re)),
n as (select node, any_value(d) depth, any_value(parent) parent, min(c) conv_id, count(*) n_convs,
             (count(*) - 1) * any_value(nbytes) own_saved,
             sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (ends), '')) ends_sha256
      from m group by node),
k as (select parent node, count(*) n_children from n where parent is not null group by parent),
a as (select n.node, n.conv_id, n.depth, n.own_saved, coalesce(k.n_children, 0) = 0 leaf
      from n left join k using (node)),
s as (select up.node, sum(a.own_saved) saved, count(*) filter (a.leaf) leaves
      from a join m up on up.c = a.conv_id and up.d <= a.depth group by up.node)
select n.conv_id, n.depth, p.conv_id parent_conv_id, n.n_convs, coalesce(k.n_children, 0) n_children,
       s.leaves n_leaves, s.saved::bigint saved_tokens, n.ends_sha256
from n left join n p on p.node = n.parent left join k on k.node = n.node join s on s.node = n.node"""


@query
def op13_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of 2048 tokens, unpadded ones of smaller powers of two at the end."""
    return slackpack.pack(load(spark, sf_dir, "documents"), "doc_id", "text").withColumnRenamed("id", "doc_id")
