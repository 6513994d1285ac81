"""Corpus cleaning as a chain of stages; each stage's rows are written as Parquet and read by the next.

A stage takes (spark, docs, sf_dir). It reads the columns of ``documents``,
works on every row its predecessor kept, and, but for the last, returns those
columns again, other columns of ``docs`` included. Rows that share a doc_id
share a decision: one that is rejected takes the others along. Rows with a null
doc_id can't be named by a decision, so filters leave them in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from calyx.llm import decontam, linededup, minhash, packing, quality
from calyx.llm.common import distinct_by, load, without, write_table


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` less the rows whose doc_id is in the one column of ``gone``, which is computed once."""
    return without(docs, "doc_id", write_table(gone, "gone"))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier rejects go: poor form, abusive words, or no words at all.

    Null and empty texts hold no words and go. An empty table stays empty.
    """
    scores = quality.classify(docs, load(spark, sf_dir, "labels"), "doc_id", "text")
    return _without(docs, scores.filter("not kept").select("id"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates are cut from all documents but the first that has them.

    A document of which nothing is left goes; null and empty texts stay as they
    are. n_chars becomes the length of the text that is left.
    """
    rest = linededup.drop_recurring_lines(docs, "doc_id", "text")
    if "n_chars" in rest.columns:
        rest = rest.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))
    return rest


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: that with the smallest doc_id.

    Five-word shingles, similarity 0.8. Documents without words stay, and of
    rows that repeat a doc_id and a text one stays.
    """
    found = minhash.near_duplicates(docs, "doc_id", "text", k=5, percent=80)
    return distinct_by(_without(docs, found.filter("not kept").select("id")), "doc_id", ["doc_id", "text"])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item stands, give or take a fifth of its words in edits, go."""
    hits = decontam.contaminated(docs, load(spark, sf_dir, "benchmark"), "doc_id", "text")
    return _without(docs, hits.select("id"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences: a row per piece of a document, with its sequence and place there."""
    return packing.pack(docs, "doc_id", "text").withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_classifier", quality_filter),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("best_fit_packing", pack),
]

#: Trained classifiers and approximate search have no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), name)
    return docs
