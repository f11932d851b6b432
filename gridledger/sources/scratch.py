"""Tables in the folder that driver and executors share.

Every process has a folder of its own there, and every job() within it another, so what one job deletes is
its own. A job's folder goes when the job ends; the process's folder, which holds what returned frames still read, goes
when the process ends in order.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_folder: ContextVar[str] = ContextVar("folder", default=f"gridledger-{uuid.uuid4().hex}")
_swept_at_exit: set[str] = set()


def scratch_dir(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir. Only where that is unset and all runs on one machine, a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir must name a folder that driver and executors share (master: {master})")
        base = os.path.join(tempfile.gettempdir(), f"gridledger-{spark.sparkContext.applicationId}")
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    folder = f"{scratch_dir(spark)}/{_folder.get()}"
    if "/" not in _folder.get() and folder not in _swept_at_exit:
        _swept_at_exit.add(folder)
        atexit.register(_drop_at_exit, spark, folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def drop(spark: SparkSession, path: str) -> None:
    """Deletes a folder; frames that read it are void."""
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def _drop_at_exit(spark: SparkSession, folder: str) -> None:
    try:
        drop(spark, folder)
    except Exception:  # the JVM may be gone before us, and nothing is left to tell
        pass


@contextmanager
def job(spark: SparkSession) -> Iterator[None]:
    """Scratch made inside goes when the block ends. What shall outlast it is written to a path given out before."""
    outer = _folder.get()
    token = _folder.set(f"{outer}/job-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        folder = _folder.get()
        _folder.reset(token)
        drop(spark, f"{scratch_dir(spark)}/{folder}")


def stage_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Writes df once to the shared folder (to path, if one was given out for it) and returns a reader of it.

    The written files cut the lineage: what is read twice cannot differ between reads, and a lost
    executor costs a reread of files and not a recomputation of everything upstream.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
