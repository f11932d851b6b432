"""Registered queries of the training-data operators: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from gridledger.llm import exact, language, licenses, mixing, neardup, oracles, packing, secrets, shards, tokens, vectors
from gridledger.llm.common import read_table


def op1_mixing(spark, sf_dir):
    return mixing.mix(read_table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, most=2.0)


def op2_token_files(spark, sf_dir):
    return tokens.token_files(read_table(spark, sf_dir, "documents"))


def op3_vector_search(spark, sf_dir):
    return vectors.search(read_table(spark, sf_dir, "embeddings"), k=20, query_every=20)


def op4_language_id(spark, sf_dir):
    return language.identify(read_table(spark, sf_dir, "documents"), documents_per_language=1500, windows_per_document=4)


def op5_near_copies(spark, sf_dir):
    return neardup.near_copies(read_table(spark, sf_dir, "documents"), words=5, similarity=0.8)


def op6_exact_dedup(spark, sf_dir):
    return exact.exact_copies(read_table(spark, sf_dir, "documents"))


def op7_byte_shards(spark, sf_dir):
    return shards.byte_shards(read_table(spark, sf_dir, "documents"), n_shards=40)


def op8_license_scan(spark, sf_dir):
    return licenses.scan(read_table(spark, sf_dir, "documents"))


def op9_packing(spark, sf_dir):
    return packing.pack(read_table(spark, sf_dir, "documents"), capacity=2048, end_id=1)


def op10_secret_scan(spark, sf_dir):
    return secrets.scan(read_table(spark, sf_dir, "documents"))


def queries():
    return {f.__name__: f for f in (op1_mixing, op2_token_files, op3_vector_search, op4_language_id, op5_near_copies, op6_exact_dedup, op7_byte_shards, op8_license_scan, op9_packing, op10_secret_scan)}


def oracle_sql():
    """For the queries that SQL can express; the others are held against plain versions in tests/llm."""
    return {
        "op1_mixing": oracles.MIXING,
        "op5_near_copies": oracles.NEAR_COPIES,
        "op6_exact_dedup": oracles.EXACT_DEDUP,
        "op8_license_scan": oracles.license_scan(licenses.TEMPLATES, licenses.BASE),
    }
