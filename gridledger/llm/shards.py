"""Balanced contiguous shards from global byte-size prefix sums. DataFrame operations only.

Rows are ordered by document id. Per-bucket totals of an ordered range partitioning, whose buckets grow in number
with the rows, are summed over the buckets, each bucket adds its own running sums, and the global prefix is cut
at equal byte targets. No task sees more than one bucket, and the text itself is never shuffled: it is reduced to its
size and checksum in the scan.

Defined cases: a null text counts no bytes and has the checksum of the empty text; rows without an id come
last, ordered by checksum and size; repeated ids are ordered by checksum and size, and fully equal rows are
interchangeable; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridledger.llm.common import buckets_for, stage_table


def byte_shards(docs: DataFrame, n_shards: int = 40, row_overhead: int = 16) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard (0..n_shards-1), slot, grown_shard.

    A row goes to the shard whose equal share of all bytes holds the row's midpoint, so a shard's bytes
    differ from the target by at most half a row at either end.
    """
    sized = stage_table(
        docs.select(
            F.col("doc_id"),
            (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + F.lit(row_overhead)).alias("size"),
            F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        ),
        "shard-sizes",
    )
    order = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    placed = stage_table(sized.repartitionByRange(buckets_for(sized.count()), *order).withColumn("bucket", F.spark_partition_id()), "shard-buckets")

    # Totals of the buckets: one row for 20,000 of the table.
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("bucket").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    bases = totals.select(
        "bucket",
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(Window.partitionBy()).alias("all_bytes"),
    )
    inside = Window.partitionBy("bucket").orderBy(*order)
    ranked = placed.select(
        "*",
        (F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("bytes_inside"),
        (F.row_number().over(inside) - 1).alias("rows_inside"),
    ).join(bases, "bucket")
    middle = (F.col("bytes_before") + F.col("bytes_inside")) * 2 + F.col("size")
    cut = stage_table(
        ranked.select(
            "doc_id",
            "size",
            "text_crc32",
            F.least(F.lit(n_shards - 1), F.floor(middle * F.lit(n_shards).cast("decimal(10,0)") / (F.col("all_bytes") * 2))).cast("int").alias("shard"),
            (F.col("rows_before") + F.col("rows_inside")).alias("place"),
        ),
        "shard-cuts",
    )
    starts = cut.groupBy("shard").agg(F.min("place").alias("first_place"))  # n_shards rows
    return cut.join(F.broadcast(starts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("place") - F.col("first_place")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
