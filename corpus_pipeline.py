"""From raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept.  ``run``
writes what a stage returns as Parquet to the shared folder and reads it again as the next one's
documents.  All but the last stage return the columns of ``documents``.

Defined cases: a text that is null or empty fails the quality rules; of equal or similar texts the one
with the smallest id stays, and of rows with one id the one whose text has the smallest hash, whatever
their order; rows with a null id are never duplicates of anything; a null source or language is a value
of its own in the mix; texts of any length are read whole; other columns pass through, whatever they are
called; empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemint.llm.common import CARRIED, put_back, set_apart, table
from tablemint.llm.minhash import Shingling, near_duplicates
from tablemint.llm.mixing import mix
from tablemint.llm.packing import cut_pieces, default_tokenizer, pack
from tablemint.llm.pii import redact, with_spans
from tablemint.llm.rules import filter_quality
from tablemint.session import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighted quality rules keep."""
    return filter_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8 or more."""
    found = near_duplicates(docs, Shingling(width=5, threshold=80))
    gone = stage(found.filter("id <> component").select("id").distinct(), "duplicate-ids")
    columns = docs.columns
    rows = set_apart(docs, "doc_id", "text")
    named = rows.filter(F.col("doc_id").isNotNull())
    kept = named.join(gone, named["doc_id"] == gone["id"], "left_anti")
    # Ids that several rows have are looked for among ids alone, so other rows need not be grouped.
    counted = named.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1")
    repeated = stage(counted.select("doc_id"), "repeated-ids")
    order = F.struct(F.sha2("text", 256), F.xxhash64(CARRIED))
    once = kept.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(F.struct("text", CARRIED), order).alias("first"))
    unnamed = rows.filter(F.col("doc_id").isNull())
    back = kept.join(repeated, "doc_id", "left_anti").union(once.select("doc_id", "first.*")).union(unnamed)
    return put_back(back, columns, "doc_id", "text")


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    read = ["text"]
    clean = put_back(redact(with_spans(set_apart(docs, *read))), docs.columns, *read)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of the stated share of words, by the raked shares of source, language and topic.

    A document stays once or goes: one that is wanted more than once is not repeated.
    """
    read = ["doc_id", "text", "source", "lang"]
    return put_back(mix(set_apart(docs, *read)).filter("_kept"), docs.columns, *read)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequence and place."""
    placed = pack(cut_pieces(docs, default_tokenizer()))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("pii", pii),
    ("mixing", mixing),
    ("packing", packing),
]

#: SQL has no tokeniser and no near-duplicate groups; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES:
        docs = stage(work(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
