"""Where jobs put their own tables and checkpoints."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

#: Of own tables, which are written once and read a few times.
COMPRESSION = "zstd"
_BELOW = "changeloom.workspace"


def workspace(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared folder that ``spark.checkpoint.dir`` names.

    Only a local session, whose one machine runs everything, may do without that setting.
    """
    base = spark.sparkContext.getLocalProperty(_BELOW) or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="changeloom-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def below(spark: SparkSession, path: str) -> Iterator[None]:
    """Workspaces of this thread, and of those that ``together`` starts, go below a folder that the caller deletes."""
    before = spark.sparkContext.getLocalProperty(_BELOW)
    spark.sparkContext.setLocalProperty(_BELOW, path)
    try:
        yield
    finally:
        spark.sparkContext.setLocalProperty(_BELOW, before)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder, for what is used several times.

    Unlike cached blocks, it outlives the executors that computed it.
    """
    path = workspace(df.sparkSession, purpose)
    df.write.option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(spark: SparkSession, *jobs: Callable) -> list:
    """Results of jobs that do not depend on each other, submitted at the same time: small ones leave most cores idle."""
    with ThreadPoolExecutor(max(len(jobs), 1)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [one.result() for one in running]


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system holds it; one that is not there is no error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def forget_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files of jobs that are done: they stay on the executors' disks until the driver collects garbage."""
    spark._jvm.System.gc()
