"""Token-id files of directly addressable codes.

Ids are split into chunks of eight bits, lowest first. Level 0 holds the low chunk of every id; a bitmap
beside each level says which ids go on, and the next level holds only those. A rank directory (ones before
each block of 512 bits) makes any id addressable: read its chunk, and while its bit is set follow the rank
to the next level. No block is decoded for that.

Layout on disk: a Parquet dataset with one directory per ascending document-id range (`range=`), one row
per segment of whole documents; the columns of a segment are the code's own bytes and nothing in them is
compressed. Parquet is the container because Spark commits its files atomically on any store, so a lost
executor or a repeated attempt leaves no partial or double segment.

Defined cases: a null text is empty and still gets its end id; documents without an id come last, in order
of their text's hash; repeated ids follow each other in order of their text's hash; an empty table writes an
empty dataset and reads back as no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridledger.llm.common import bound_batches, buckets_for, clean_text, release_memory, scratch_path
from gridledger.llm.encoder import default_vocabulary, encoder

#: Bits between two entries of a rank directory.
RANK_BLOCK = 512
#: A segment is closed by the document that reaches this many ids.
SEGMENT_IDS = 1 << 19

_LEVELS = "array<struct<chunks:binary,bitmap:binary,ranks:binary>>"
_SEGMENT = f"range int, segment int, n_ids bigint, doc_ids array<bigint>, doc_ends array<bigint>, levels {_LEVELS}"


# ---- the code itself -------------------------------------------------------------------------------------
def dac_encode(ids: np.ndarray) -> list[dict[str, bytes]]:
    """Levels of the code of unsigned 32-bit ids."""
    levels = []
    rest = ids.astype("<u4", copy=False)
    while rest.size:
        more = rest > 0xFF
        bitmap = np.packbits(more, bitorder="little")
        ones = np.add.reduceat(more, np.arange(0, more.size, RANK_BLOCK), dtype=np.int64)
        ranks = np.concatenate(([0], np.cumsum(ones)[:-1])).astype("<u4")
        levels.append({"chunks": (rest & 0xFF).astype("u1").tobytes(), "bitmap": bitmap.tobytes(), "ranks": ranks.tobytes()})
        rest = rest[more] >> 8
    return levels


def dac_decode(levels: list[dict[str, bytes]]) -> np.ndarray:
    """All ids of a segment."""
    out = None
    for level in reversed(levels):
        chunks = np.frombuffer(level["chunks"], "u1")
        if out is None:
            out = chunks.astype("<u4")
            continue
        more = np.unpackbits(np.frombuffer(level["bitmap"], "u1"), count=chunks.size, bitorder="little").view(bool)
        whole = np.zeros(chunks.size, "<u4")
        whole[more] = out
        whole <<= 8
        whole |= chunks
        out = whole
    return np.zeros(0, "<u4") if out is None else out


def dac_access(levels: list[dict[str, bytes]], i: int) -> int:
    """The i-th id, from one chunk a level; only the bits of one rank block are counted."""
    value, shift = 0, 0
    for level in levels:
        value |= level["chunks"][i] << shift
        if not level["bitmap"][i >> 3] >> (i & 7) & 1:
            break
        block = i // RANK_BLOCK
        rank = int(np.frombuffer(level["ranks"], "<u4", count=1, offset=4 * block)[0])
        first = block * RANK_BLOCK // 8
        bits = int.from_bytes(level["bitmap"][first : (i >> 3) + 1], "little") & ((1 << (i - block * RANK_BLOCK)) - 1)
        i, shift = rank + bits.bit_count(), shift + 8
    return value


# ---- writing ---------------------------------------------------------------------------------------------
def write_token_files(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = 0, rows_per_range: int = 50_000) -> str:
    """Encodes every whole text, appends end_id, and writes the segments in ascending doc_id order."""
    bound_batches(docs.sparkSession)
    vocabulary = vocabulary or default_vocabulary()
    rows = docs.select("doc_id", clean_text().alias("text"))
    order = [F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64("text")]
    dealt = rows.repartitionByRange(buckets_for(docs.count(), rows_per_range), *order).sortWithinPartitions(*order).select(F.spark_partition_id().alias("range"), "doc_id", "text")
    dealt.mapInArrow(_segments(vocabulary, end_id), _SEGMENT).write.partitionBy("range").option("compression", "uncompressed").parquet(path)
    return path


def _segments(vocabulary: str, end_id: int):
    end = np.asarray([end_id], "<u4").tobytes()
    kinds = {"range": pa.int32(), "segment": pa.int32(), "n_ids": pa.int64(), "doc_ids": pa.list_(pa.int64()), "doc_ends": pa.list_(pa.int64())}
    kinds["levels"] = pa.list_(pa.struct([("chunks", pa.binary()), ("bitmap", pa.binary()), ("ranks", pa.binary())]))
    schema = pa.schema(list(kinds.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = encoder(vocabulary)
        at, number, doc_ids, parts, size = None, 0, [], [], 0

        def closed() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u4")
            ends = np.cumsum([len(p) // 4 for p in parts]).tolist()
            row = {"range": at, "segment": number, "n_ids": ids.size, "doc_ids": list(doc_ids), "doc_ends": ends, "levels": dac_encode(ids)}
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                rows = zip(part["range"].to_pylist(), part["doc_id"].to_pylist(), codes.encode(part["text"].to_pylist()))
                for key, doc_id, coded in rows:
                    if doc_ids and (key != at or size >= SEGMENT_IDS):
                        yield closed()
                        number, doc_ids, parts, size = number + 1 if key == at else 0, [], [], 0
                    elif key != at:
                        number = 0
                    at = key
                    doc_ids.append(doc_id)
                    parts.append(coded + end)
                    size += len(coded) // 4 + 1
            release_memory()
        if doc_ids:
            yield closed()

    return run


# ---- reading ---------------------------------------------------------------------------------------------
def read_segments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_SEGMENT).parquet(path)


def segment_starts(segments: DataFrame) -> DataFrame:
    """range, segment, first_id: ids before each segment, summed within ranges and then over the ranges."""
    inside = Window.partitionBy("range").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = segments.select("range", "segment", "n_ids")
    # As many rows as ranges: one for 50,000 documents.
    totals = sizes.groupBy("range").agg(F.sum("n_ids").alias("ids")).select("range", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("range_start"))
    return sizes.select("range", "segment", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("inside")).join(totals, "range").select(
        "range", "segment", (F.col("range_start") + F.col("inside")).alias("first_id")
    )


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            ids = dac_decode(row["levels"])
            raw = memoryview(ids.tobytes())
            ends = np.asarray(row["doc_ends"], np.int64)
            starts = np.concatenate(([0], ends[:-1]))
            crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_pydict(
                {
                    "range": pa.array([row["range"]] * len(ends), pa.int32()),
                    "segment": pa.array([row["segment"]] * len(ends), pa.int32()),
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "inside": pa.array(starts, pa.int64()),
                    "n_tokens": pa.array(ends - starts, pa.int64()),
                    "ids_crc32": pa.array(crcs, pa.int64()),
                }
            )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files alone."""
    segments = read_segments(spark, path)
    documents = segments.select("range", "segment", "doc_ids", "doc_ends", "levels").mapInArrow(
        _documents, "range int, segment int, doc_id bigint, inside bigint, n_tokens bigint, ids_crc32 bigint"
    )
    return documents.join(segment_starts(segments), ["range", "segment"]).select("doc_id", (F.col("first_id") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def _addressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        positions, ids = [], []
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            positions += [row["first_id"] + k for k in row["inside"]]
            ids += [dac_access(row["levels"], k) for k in row["inside"]]
        yield pa.RecordBatch.from_arrays([pa.array(positions, pa.int64()), pa.array(ids, pa.int64())], names=["position", "id"])


def tokens_at(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """position, id of tokens anywhere in the files, each read from its place in its segment; positions: position bigint.

    Positions and segments meet in stretches of SEGMENT_IDS ids, of which a segment covers two or three, and a long document's
    more. Positions that the files don't have, and null ones, give no row; a repeated position gives one.
    """
    segments = read_segments(spark, path)
    places = segment_starts(segments).join(segments.select("range", "segment", "n_ids"), ["range", "segment"]).where("n_ids > 0")
    spans = places.withColumn("stretch", F.explode(F.expr(f"sequence(first_id div {SEGMENT_IDS}, (first_id + n_ids - 1) div {SEGMENT_IDS})")))
    asked = positions.select(F.col("position").cast("bigint").alias("position")).where("position >= 0").distinct().withColumn("stretch", F.expr(f"position div {SEGMENT_IDS}"))
    found = asked.join(spans, "stretch").where("position >= first_id and position < first_id + n_ids")
    # A segment's positions go to it in rows of bounded length.
    by_segment = found.withColumn("part", F.expr("(position - first_id) div 65536")).groupBy("range", "segment", "first_id", "part").agg(F.collect_list(F.col("position") - F.col("first_id")).alias("inside"))
    rows = by_segment.join(segments.select("range", "segment", "levels"), ["range", "segment"]).select("first_id", "inside", "levels")
    return rows.mapInArrow(_addressed, "position bigint, id bigint")


def token_files(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Writes the files to the shared folder and reads every document's row back from them."""
    spark = docs.sparkSession
    return read_documents(spark, write_token_files(docs, scratch_path(spark, "token-files"), vocabulary))
