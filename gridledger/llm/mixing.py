"""Mixing sources to target weights with a low-discrepancy schedule.

Each source is a stream: its documents in shuffled order, cut into blocks of equal words. Slot i of the
schedule has the point i * golden ratio mod 1 (in exact 64-bit arithmetic), which the cumulative shares of the
sources turn into a source; the r-th slot of a source takes the r-th block of its stream, starting over at the
end. Every stretch of the schedule therefore holds each source in its share, up to a logarithm of slots.

How many of the first n points fall to a source has a closed form (a floor sum), so any range of slots knows
its ranks without looking at the others. The few slots by which a source is short at the end follow as a
tail, and its last block is cut at its target: each source's words are its target, rounded down.

Defined cases: a null text has no words and is never taken; a null source is a source of its own, the last;
documents of equal id are ordered by size, and equal rows are interchangeable; a null id takes part like any
other, in an order given by its text; an empty table gives no rows; other columns are not read by mix() and kept by mixed_documents().
The sources and their weights are settings of a mix, so their list is held by the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridledger.llm.common import buckets_for, stage_table

WORD = r"[^\x20\x09-\x0D]+"
#: 2**64 divided by the golden ratio, made odd.
GOLDEN = 0x9E3779B97F4A7C15
TURN = 1 << 64
BLOCK_WORDS = 512
SLOTS_PER_TASK = 1 << 16
#: Facts of so many sources are broadcast; those of more are joined by shuffle.
BROADCAST_SOURCES = 10_000


def _small(facts: DataFrame, sources: int) -> DataFrame:
    return F.broadcast(facts) if sources <= BROADCAST_SOURCES else facts


# ---- targets and schedule --------------------------------------------------------------------------------
def targets(sizes: Sequence[int], weights: Sequence[float], share: float = 1.5, most: float = 2.0) -> list[float]:
    """Words for each source: share of all sizes by weight, none above most times its size; excess is reshared.

    In order of most * size / weight, the first source that its weight's level doesn't fill ends the filled
    ones: resharing by weight again and again comes to the same level.
    """
    total = share * sum(sizes)
    order = sorted(range(len(sizes)), key=lambda i: most * sizes[i] / weights[i])
    out, spent, weight = [0.0] * len(sizes), 0.0, float(sum(weights))
    for n, i in enumerate(order):
        level = (total - spent) / weight
        if level * weights[i] <= most * sizes[i]:
            for j in order[n:]:
                out[j] = level * weights[j]
            break
        out[i] = most * sizes[i]
        spent += out[i]
        weight -= weights[i]
    return out


def floor_sum(n: int, m: int, a: int, b: int) -> int:
    """Sum of (a*i + b) // m for i < n, by the Euclidean steps of a and m."""
    total = 0
    while n > 0:
        total += (n - 1) * n // 2 * (a // m) + n * (b // m)
        a, b = a % m, b % m
        top = a * n + b
        if top < m:
            break
        n, b = divmod(top, m)
        m, a = a, m
    return total


def points_below(n: int, x: int) -> int:
    """How many i < n have i * GOLDEN mod 2**64 < x."""
    return floor_sum(n, TURN, GOLDEN, 0) - floor_sum(n, TURN, GOLDEN, TURN - x) + n if x else 0


@dataclass(frozen=True)
class Plan:
    """What the schedule needs of each source: its size, target, blocks and slots; ends of its share of a turn."""

    sizes: tuple[int, ...]
    goals: tuple[int, ...]
    block: int

    @property
    def blocks(self) -> list[int]:
        return [-(-s // self.block) for s in self.sizes]

    @property
    def slots(self) -> list[int]:
        out = []
        for s, g, n in zip(self.sizes, self.goals, self.blocks):
            turns, rest = divmod(g, s) if s else (0, 0)
            out.append(turns * n + -(-rest // self.block))
        return out

    @property
    def ends(self) -> list[int]:
        slots = self.slots
        total = max(1, sum(slots))
        return [TURN * so_far // total for so_far in accumulate(slots)]


def schedule(spark: SparkSession, plan: Plan) -> DataFrame:
    """slot, source_no, rank, epoch, block, words: the whole mix in order."""
    slots, ends, blocks = plan.slots, plan.ends, plan.blocks
    n = sum(slots)
    below = [points_below(n, e) for e in ends]
    had = [b - a for a, b in zip([0, *below], below)]
    lacking = [(s, r) for s, (h, k) in enumerate(zip(had, slots)) for r in range(h, k)]
    tail = [(n + i, s, r) for i, (s, r) in enumerate(lacking)]
    schema = "slot bigint, source_no int, rank bigint"
    starts = spark.range(0, n, SLOTS_PER_TASK).withColumnRenamed("id", "first")
    body = starts.repartition(max(1, -(-n // SLOTS_PER_TASK))).mapInPandas(_slots(n, ends), schema)
    taken = body.unionByName(spark.createDataFrame(tail, schema)) if tail else body
    facts = spark.createDataFrame(list(zip(range(len(slots)), plan.sizes, plan.goals, blocks, slots)), "source_no int, size_of bigint, goal bigint, n_blocks bigint, n_slots bigint")
    epoch, block = F.expr("rank div n_blocks"), F.expr("rank % n_blocks")
    first = F.col("epoch") * F.col("size_of") + F.col("block") * plan.block
    length = F.least(F.lit(plan.block), F.col("size_of") - F.col("block") * plan.block, F.col("goal") - first)
    return (
        taken.join(_small(facts, len(slots)), "source_no")
        .where(F.col("rank") < F.col("n_slots"))
        .withColumns({"epoch": epoch, "block": block})
        .withColumn("words", length)
        .select("slot", "source_no", "rank", "epoch", "block", "words")
    )


def _slots(n: int, ends: list[int]):
    cuts = np.array([min(e, TURN - 1) for e in ends], np.uint64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for first in pdf["first"]:
                first = int(first)
                slot = np.arange(first, min(n, first + SLOTS_PER_TASK), dtype=np.uint64)
                with np.errstate(over="ignore"):
                    point = slot * np.uint64(GOLDEN)
                source = np.minimum(np.searchsorted(cuts, point, side="right"), len(ends) - 1)
                rank = np.zeros(len(slot), np.int64)
                before = 0
                for s in np.unique(source):
                    before = points_below(first, ends[s]) - (points_below(first, ends[s - 1]) if s else 0)
                    at = np.flatnonzero(source == s)
                    rank[at] = before + np.arange(len(at))
                yield pd.DataFrame({"slot": slot.astype(np.int64), "source_no": source.astype(np.int32), "rank": rank})

    return run


# ---- streams and the mix ---------------------------------------------------------------------------------
def _taken(docs: DataFrame, weights: Sequence[float], share: float, most: float, block_words: int) -> tuple[DataFrame, list[dict]]:
    """Rows (doc_id, text_key, source_no, size, epoch, words) for each document and epoch it is taken in, or one
    with a null epoch and no words; and the sources."""
    spark = docs.sparkSession
    sized = stage_table(
        docs.select(
            "doc_id",
            "source",
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.xxhash64("text").alias("text_key"),
            F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.coalesce("text", F.lit("")))))).alias("shuffle"),
        ),
        "mix-sizes",
    )
    # Strings compare by their UTF-8 bytes, which is the order of code points.
    named = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")).collect()
    named.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    sizes = [r["size"] for r in named]
    per = [weights[i % len(weights)] for i in range(len(named))]
    goals = targets(sizes, per, share, most)
    sources = [{"source": r["source"], "source_no": i, "source_size": s, "target": g} for i, (r, s, g) in enumerate(zip(named, sizes, goals))]
    plan = Plan(tuple(sizes), tuple(int(g) for g in goals), block_words)

    facts = spark.createDataFrame([(x["source"], x["source_no"]) for x in sources], "source string, source_no int")
    buckets = buckets_for(sum(r["rows"] for r in named))
    numbered = sized.join(_small(facts, len(sources)), sized["source"].eqNullSafe(facts["source"])).select(
        "source_no", "doc_id", "text_key", "size", "shuffle", F.expr(f"cast(conv(substr(shuffle, 1, 8), 16, 10) as bigint) * {buckets} div 4294967296").cast("int").alias("bucket")
    )
    totals = numbered.groupBy("source_no", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("source_no", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source_no", "bucket").orderBy("shuffle", "size", "text_key")
    streamed = numbered.withColumns(
        {"row": F.row_number().over(inside), "inside": F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")}
    ).join(bases, ["source_no", "bucket"])
    # A document's words lie in consecutive blocks of its source's stream.
    start = F.col("base") + F.col("inside")
    pieces = (
        streamed.withColumn("start", start)
        .withColumn("blocks", F.when(F.col("size") > 0, F.expr(f"sequence(start div {block_words}, (start + size - 1) div {block_words})")))
        .select("source_no", "bucket", "row", "doc_id", "text_key", "size", "start", F.explode_outer("blocks").alias("block"))
        .withColumn("lo", F.greatest(F.col("start") - F.col("block") * block_words, F.lit(0)))
        .withColumn("hi", F.least(F.col("start") + F.col("size") - F.col("block") * block_words, F.lit(block_words)))
    )
    if not plan.slots or not sum(plan.slots):
        joined = pieces.withColumns({"epoch": F.lit(None).cast("long"), "words": F.lit(0).cast("long")})
    else:
        slots = schedule(spark, plan).select("source_no", "block", "epoch", F.col("words").alias("slot_words"))
        joined = pieces.join(slots, ["source_no", "block"], "left").withColumn("words", F.greatest(F.least("hi", F.coalesce("slot_words", F.lit(0))) - F.col("lo"), F.lit(0)))
    keys = ["source_no", "bucket", "row", "doc_id", "text_key", "size"]
    return joined.groupBy(*keys, "epoch").agg(F.coalesce(F.sum("words"), F.lit(0)).alias("words")), sources


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    taken, sources = _taken(docs, weights, share, most, block_words)
    facts = docs.sparkSession.createDataFrame([(x["source_no"], x["source_size"], float(x["target"])) for x in sources], "source_no int, source_size bigint, target double")
    return (
        taken.groupBy("source_no", "bucket", "row", "doc_id", "text_key", "size")
        .agg(F.sum("words").alias("taken"))
        .join(_small(facts, len(sources)), "source_no")
        .select("doc_id", "size", "source_size", "target", "taken")
    )


def mixed_documents(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix as documents: each as often as it is taken; where a source's target ends inside a document, its words up to there.

    The columns are those of docs. The copies of a row that is taken twice are alike.
    """
    taken, _ = _taken(docs, weights, share, most, block_words)
    alike = Window.partitionBy("doc_id", "text_key")
    marked = F.row_number().over(alike.orderBy("source_no", "bucket", "row"))
    epochs = (
        taken.where("words > 0")
        .groupBy("source_no", "bucket", "row", "doc_id", "text_key", "size")
        .agg(F.collect_list("words").alias("epochs"))  # as many as times a document may be taken
        .withColumn("copy", marked)
        .select("doc_id", "text_key", "size", "copy", "epochs")
    )
    columns = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("d")).withColumns({"doc_id": F.col("d.doc_id"), "text_key": F.xxhash64("d.text")})
    rows = rows.withColumn("copy", F.row_number().over(alike.orderBy("d.source", "text_key")))
    cut = F.concat_ws(" ", F.slice(F.regexp_extract_all("d.text", F.lit(WORD), 0), 1, F.col("words").cast("int")))
    text = F.when(F.col("words") < F.col("size"), cut).otherwise(F.col("d.text"))
    both = rows.join(epochs, rows["doc_id"].eqNullSafe(epochs["doc_id"]) & (rows["text_key"] == epochs["text_key"]) & (rows["copy"] == epochs["copy"]))
    out = both.select("d", "size", F.explode("epochs").alias("words"))
    made = {"text": text, "n_chars": F.length(text).cast(dict(docs.dtypes).get("n_chars", "bigint"))}
    return out.select(*[made[c].alias(c) if c in made else F.col(f"d.`{c}`").alias(c) for c in columns])
