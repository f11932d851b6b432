"""A training corpus from raw documents: language, exact copies, near copies, mixing, packing.

Each stage takes the documents that its predecessor kept, and all but the last return documents. Between
stages the documents are written as Parquet and read again, so each stage starts from files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridledger.llm import exact, language, mixing, neardup, packing
from gridledger.llm.common import read_table, stage_table
from gridledger.sources import scratch


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go."""
    return language.accepted(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by near-equal shingles, the one with the smallest doc_id stays."""
    return neardup.first_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("language_id", keep_known_languages),
    ("exact_dedup", drop_exact_copies),
    ("near_copies", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

#: The network, MinHash and the tokenizer have no SQL form; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage needed on its way goes when its documents are written, and these when the next one's are."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch.scratch_path(spark, f"pipeline-{name}")
        with scratch.job(spark):
            docs = stage_table(stage(spark, docs, sf_dir), name, path)
        if before:
            scratch.drop(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
