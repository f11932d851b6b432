"""Exact deduplication through stateful streaming.

The arrivals (id, SHA-256, byte length and file of each document; never its text) flow through a streaming
aggregation. Its state lives on disk (RocksDB, checkpointed to the shared folder), keyed by digest and
length, without expiry: the stable identifier, the content locator and the number of rows. Copies are merged
in the tasks that read them, before any shuffle, so a digest with a third of all rows is no hot key.

A state that is given a folder outlasts the call: after a failure the same call goes on behind the last batch that was
committed, and a call with another batch of documents is held against all that arrived before.

Where a digest was hit more than once, the full bytes are compared: the least and the greatest text of the
digest must be the same. They are found in two steps for crowded digests, so that no task holds a group or gets a text
from every other task. Digests that collide are grouped anew by their texts.

Defined cases: a null text counts as empty; every row gives a row, repeated ones too (rows equal in id and text are all
`kept` if they hold the largest id; without_copies() keeps one of them); a null id ranks below all others; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridledger.llm.common import clean_text, scratch_path, stage_table
from gridledger.sources.scratch import exists

_ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "8",
    # Many small stores: no space is set aside for their logs.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    # Executors close the stores of ended queries at the next maintenance.
    "spark.sql.streaming.stateStore.maintenanceInterval": "5s",
}
#: Copies of a digest for each part in which its texts are compared first, and the most such parts.
COPIES_PER_PART = 64
PARTS = 256


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _arrivals(docs: DataFrame, digest) -> DataFrame:
    text = clean_text()
    return docs.select("doc_id", digest(text).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"), F.input_file_name().alias("locator"))


def absorb(spark: SparkSession, state: str, schema, files_per_batch: int, after_batch=None) -> None:
    """Runs the stream over the arrivals under state that it hasn't seen.

    Each batch hands on the keys it changed, written under the batch's number, so a batch that is run again
    replaces its own rows. after_batch is called with the number of each batch that was written.
    """

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{state}/changed/batch={batch}")
        if after_batch:
            after_batch(batch)

    before = {k: spark.conf.get(k, None) for k in _ROCKSDB}
    try:
        for k, v in _ROCKSDB.items():
            spark.conf.set(k, v)
        stream = (
            spark.readStream.schema(schema)
            .option("maxFilesPerTrigger", files_per_batch)
            .option("recursiveFileLookup", "true")
            .parquet(f"{state}/arrivals")
            .groupBy("digest", "n_bytes")
            .agg(F.max(F.struct("doc_id", "locator")).alias("keeper"), F.count(F.lit(1)).alias("group_size"))
        )
        query = stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{state}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def known(spark: SparkSession, state: str) -> DataFrame:
    """What a state has come to: digest, n_bytes, keep_id, locator, group_size. The keeper and the number of rows of a key only rise."""
    kind = "digest string, n_bytes bigint, keeper struct<doc_id:bigint,locator:string>, group_size bigint"
    changed = f"{state}/changed"
    rows = spark.read.schema(kind).parquet(changed) if exists(spark, changed) else spark.createDataFrame([], kind)  # no arrivals, no batch
    last = rows.groupBy("digest", "n_bytes").agg(F.max("keeper").alias("keeper"), F.max("group_size").alias("group_size"))
    return last.select("digest", "n_bytes", F.col("keeper.doc_id").alias("keep_id"), F.col("keeper.locator").alias("locator"), "group_size")


def exact_copies(docs: DataFrame, digest=sha256, files_per_batch: int = 64, state: str | None = None, batch: str = "documents", earlier: DataFrame | None = None, after_batch=None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256. Of equal texts the largest doc_id stays.

    state: a folder that outlasts the call. batch: the name of these documents there; documents whose arrivals are there
    under that name already aren't read for them again. earlier: the documents of the batches before, whose bytes are compared as well.
    """
    spark = docs.sparkSession
    state = state or scratch_path(spark, "dedup-state")
    path = f"{state}/arrivals/{batch}"
    arriving = _arrivals(docs, digest)
    if not exists(spark, f"{path}/_SUCCESS"):
        arriving.write.mode("overwrite").parquet(path)
    arrivals = spark.read.schema(arriving.schema).parquet(path)
    absorb(spark, state, arriving.schema, files_per_batch, after_batch)
    # Written, so that the join with the arrivals has two plain shuffles, of which a hot digest's side can be split.
    keys = stage_table(known(spark, state), "dedup-keys").drop("locator")
    columns = ["doc_id", "digest", "n_bytes", "keep_id", "group_size"]
    members = stage_table(arrivals.drop("locator").join(keys, ["digest", "n_bytes"]).select(*columns), "dedup-members")

    # Full bytes of every hit. The semi join lets only texts of repeated digests through.
    texts, hits = docs.select("doc_id", "text"), members
    if earlier is not None:
        texts = texts.unionByName(earlier.select("doc_id", "text"))
        hits = spark.read.schema(arriving.schema).option("recursiveFileLookup", "true").parquet(f"{state}/arrivals").join(keys, ["digest", "n_bytes"])
    hit = stage_table(hits.where("group_size > 1").groupBy("doc_id", "digest").agg(F.max("group_size").alias("copies")), "dedup-hits")
    text = clean_text()
    texts = texts.select("doc_id", text.alias("text"), digest(text).alias("digest"))
    hit = hit.withColumnRenamed("doc_id", "hit_id").withColumnRenamed("digest", "hit_digest")
    # Merged at every size, so that the work grows with the input and not by a change of plan.
    hit_texts = texts.join(hit.hint("merge"), texts["doc_id"].eqNullSafe(hit["hit_id"]) & (texts["digest"] == hit["hit_digest"])).select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"), "text", "copies")
    # A task sends one text of a digest to the part that the task's number picks, and each part sends one on.
    parts = F.least(F.lit(PARTS), F.ceil(F.col("copies") / COPIES_PER_PART))
    bounds = [F.min("text").alias("least"), F.max("text").alias("greatest")]
    partly = hit_texts.withColumn("parts", parts).withColumn("part", F.pmod(F.spark_partition_id(), F.col("parts")))
    partly = partly.groupBy("digest", "n_bytes", "parts", "part").agg(*bounds).where("parts > 1 or least <> greatest")
    again = partly.groupBy("digest", "n_bytes").agg(F.min("least").alias("least"), F.max("greatest").alias("greatest"))
    unlike = stage_table(again.where("least <> greatest").select("digest", "n_bytes"), "dedup-collisions")
    found = members.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest", "n_bytes")
    if not unlike.isEmpty():
        keyed = hit_texts.join(unlike, ["digest", "n_bytes"], "left_semi").withColumn("full", sha256(F.col("text")))
        groups = keyed.groupBy("digest", "n_bytes", "full", "text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        own = docs.select("doc_id", text.alias("text"), digest(text).alias("digest")).withColumn("n_bytes", F.octet_length("text").cast("long")).join(unlike, ["digest", "n_bytes"], "left_semi").withColumn("full", sha256(F.col("text")))
        told = own.join(groups, ["digest", "n_bytes", "full", "text"]).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest", "n_bytes")
        found = found.join(unlike, ["digest", "n_bytes"], "left_anti").unionByName(told)
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with all their columns. Of rows equal in id and text one stays: the one with the
    smallest hash of all its columns, so that the choice is the same each time."""
    kept = exact_copies(docs).where("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_sha256"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"), F.col("doc_id").alias("row_id"), sha256(clean_text()).alias("row_sha256"))
    stays = rows.join(kept, rows["row_id"].eqNullSafe(kept["kept_id"]) & (rows["row_sha256"] == kept["kept_sha256"]), "left_semi")
    return stays.groupBy("row_id", "row_sha256").agg(F.min_by("d", F.xxhash64("d")).alias("d")).select("d.*")
