"""Page documents as a stream: new files become rows of a stage table, each page's latest document wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridledger.sources.documents import write_stage
from gridledger.sources.specs import page_of_path


def read_page_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1000) -> DataFrame:
    """JSON page documents as they arrive, with page and time of the file; other names are passed over."""
    rows = spark.readStream.schema(schema).option("multiLine", True).option("maxFilesPerTrigger", files_per_batch).json(path)
    return rows.select("*", F.col("_metadata.file_modification_time").alias("seen"), page_of_path(F.col("_metadata.file_path")).alias("page_no")).where(F.col("page_no").isNotNull())


def write_page_stream(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Every batch replaces the partitions of its pages, so a batch that runs again writes the same."""

    def put(batch: DataFrame, _: int) -> None:
        latest = batch.groupBy("page_no").agg(F.max_by(F.struct(*[c for c in batch.columns if c != "page_no"]), "seen").alias("r"))
        write_stage(latest.select("r.*", F.col("page_no").alias("page")), path)

    stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def flag_counts(stream: DataFrame, every: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """window, code, n of flags by the time their page was seen; rows later than `late` don't change a closed window."""
    flags = stream.select("seen", F.explode("flags").alias("code"))
    return flags.withWatermark("seen", late).groupBy(F.window("seen", every), "code").agg(F.count(F.lit(1)).alias("n"))
