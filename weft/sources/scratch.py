"""Shared scratch storage for written intermediate data.

Files go under ``spark.checkpoint.dir``, the folder every executor can reach.
Only a local-mode session without that setting gets a temporary folder.
"""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    """A temporary folder for local mode, deleted at exit. The session's own
    checkpoint folder is left as it is."""
    folder = tempfile.mkdtemp(prefix="weft-scratch-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path; nothing is created yet."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/{app}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a scan of it.

    Later passes read the files, so they all see the same rows and partition
    numbers, also after executors are lost, and prune to the columns they need.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
