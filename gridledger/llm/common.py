"""Shared helpers of the training-data operators."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridledger.sources.scratch import scratch_dir, scratch_path, stage_table

__all__ = ["bound_batches", "buckets_for", "clean_text", "read_table", "release_memory", "scratch_dir", "scratch_path", "stage_table"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def release_memory() -> None:
    """Gives memory that a worker has freed back to the system; workers live on between tasks, and keep it otherwise."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not every C library has it
        pass


def bound_batches(spark: SparkSession, megabytes: int = 8) -> None:
    """Bounds the Arrow batches that workers get, whatever the length of texts; holds for the session."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{megabytes}m")


def clean_text(column: str | Column = "text") -> Column:
    """The text, null as empty."""
    col = F.col(column) if isinstance(column, str) else column
    return F.coalesce(col, F.lit(""))


def buckets_for(rows: int, rows_per_bucket: int = 20_000, least: int = 64) -> int:
    """A number of range buckets in proportion to the rows."""
    return max(least, -(-rows // rows_per_bucket))
