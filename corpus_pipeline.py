"""Corpus pipeline: quality rules, one document per near-duplicate group, secrets removed, packed.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read again as the
next stage's documents. All but the last return the columns of ``documents``.

Edge cases: null or empty texts fail the quality rules; rows repeating an id are separate
documents (the smallest of a near-duplicate group by text hash stays where ids tie); empty
tables pass through every stage; extra columns are carried to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordlink.llm.common import documents, keep
from recordlink.llm.op2_packing import pack
from recordlink.llm.op3_quality import quality_filter
from recordlink.llm.op6_secrets import redact_documents
from recordlink.llm.op8_jaccard import one_per_component


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior quality passes."""
    return quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at Jaccard 0.8 or more."""
    return one_per_component(docs, k=5, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets replaced by a mark and ``n_chars`` counted anew."""
    return redact_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 ids. Executors' heaps are full after the join: fewer words are held."""
    return pack(docs, length=4096, end_id=2, cache_words=300_000)


STAGES = [("quality rules", quality), ("n-gram Jaccard join", near_duplicates), ("secret scans", secrets),
          ("packing", packing)]

# No stage but the base counts can be said in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result lacks the binary ids so that rows compare by value."""
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = keep(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs.drop("ids")
