"""Packing documents into windows of equal capacity by multiway differencing (Karmarkar and Karp).

A document's ids are cut into whole windows and a rest; the rest is cut into pieces of at most a quarter
window, which lets the differencing level them. Pieces are dealt by hash into groups worth a fixed number of
windows. In a group each piece starts as a partial partition of its own; the two with the widest spread are
merged, the largest loads of one on the smallest of the other, until one partition is left. If its largest
window exceeds the capacity, the group is partitioned again with one window more.

The ids never leave the task that encodes a document unless they are asked for: what is shuffled is one
short row a piece.

Defined cases: a null text is empty and has its end id alone; repeated rows are packed once each, with equal
doc_id and start; a null doc_id is carried as null; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridledger.llm.common import bound_batches, clean_text, release_memory, stage_table
from gridledger.llm.encoder import default_vocabulary, encoder

WINDOWS_PER_GROUP = 128


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """Indices of sizes in k parts with near-equal sums: multiway differencing.

    A partial partition lists its nonzero loads, largest first; the others up to k are zero.
    """
    heap = [(-s, i, [(s, (i,))]) for i, s in enumerate(sizes)]  # (-spread, order, loads)
    heapq.heapify(heap)
    number = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        # a's largest loads meet b's smallest: zeros first, then b from its end.
        free = k - len(b)
        if len(a) <= free:
            merged = a + b
        else:
            paired = [(x + y, (p, q)) for (x, p), (y, q) in zip(a[free:], reversed(b))]
            merged = a[:free] + paired + b[: len(b) - len(paired)]
        merged.sort(key=lambda load: -load[0])
        spread = merged[0][0] - (merged[-1][0] if len(merged) == k else 0)
        number += 1
        heapq.heappush(heap, (-spread, number, merged))
    parts = [_leaves(node) for _, node in heap[0][2]] if heap else []
    return parts + [[] for _ in range(k - len(parts))]


def _leaves(node) -> list[int]:
    out, stack = [], [node]
    while stack:
        x = stack.pop()
        if isinstance(x, int):
            out.append(x)
        else:
            stack.extend(x)
    return out


def balanced_windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Parts whose sums are at most capacity; the number of parts rises until they are."""
    k = -(-sum(sizes) // capacity)
    while k:
        parts = difference(sizes, k)
        if max(sum(sizes[i] for i in p) for p in parts) <= capacity:
            return [p for p in parts if p]
        k += 1
    return []


def _pieces(vocabulary: str, end_id: int, capacity: int, keep_ids: bool):
    end = np.asarray([end_id], "<u4").tobytes()
    most = max(1, capacity // 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, ordinal = encoder(vocabulary), 0
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                rows = []
                for doc_id, coded in zip(part["doc_id"].to_pylist(), codes.encode(part["text"].to_pylist())):
                    raw = memoryview(coded + end)
                    n = len(raw) // 4
                    whole = n - n % capacity
                    starts = [*range(0, whole, capacity), *range(whole, n, most)]
                    for a, b in zip(starts, [*starts[1:], n]):
                        rows.append((doc_id, a, b - a, zlib.crc32(raw[4 * a : 4 * b]), n, ordinal % 65536, bytes(raw[4 * a : 4 * b]) if keep_ids else None))
                    ordinal += 1
                kinds = {"doc_id": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "doc_tokens": pa.int64(), "salt": pa.int32(), "ids": pa.binary()}
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds.values())], names=list(kinds))
            release_memory()

    return run


def _pack(capacity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "start", "ids_crc32"], kind="stable", na_position="last").reset_index(drop=True)
        sizes = pdf["length"].to_numpy()
        rest = np.flatnonzero(sizes < capacity)
        parts = balanced_windows(sizes[rest].tolist(), capacity)
        window, offset = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        for w, part in enumerate(parts):
            at = rest[sorted(part)]
            window[at] = w
            offset[at] = np.cumsum(sizes[at]) - sizes[at]
        full = np.flatnonzero(sizes == capacity)
        window[full] = len(parts) + np.arange(len(full))
        pdf["sequence_id"] = pdf["group"].to_numpy(np.int64) * (1 << 32) + window
        pdf["offset"] = offset
        return pdf.drop(columns=["group"])

    return run


def pack(docs: DataFrame, capacity: int = 2048, end_id: int = 1, vocabulary: str | None = None, keep_ids: bool = False) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, if kept)."""
    bound_batches(docs.sparkSession)
    pieces = stage_table(
        docs.select("doc_id", clean_text().alias("text")).mapInArrow(
            _pieces(vocabulary or default_vocabulary(), end_id, capacity, keep_ids),
            "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, salt int, ids binary",
        ),
        "pack-pieces",
    )
    rest = pieces.where(F.col("length") < capacity).agg(F.sum("length")).first()[0] or 0
    groups = max(1, rest // (WINDOWS_PER_GROUP * capacity))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * keep_ids
    # The salt parts repeated rows, which would hash alike.
    grouped = pieces.select(*columns, F.pmod(F.xxhash64("doc_id", "start", "salt"), F.lit(groups)).alias("group"))
    schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + ", ids binary" * keep_ids
    return grouped.groupBy("group").applyInPandas(_pack(capacity), f"{schema}, sequence_id bigint, offset bigint")
