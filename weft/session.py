"""Session settings. Library functions take a session and never build one."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession


def session_builder(
    app: str,
    *,
    master: str | None = None,
    hive: bool = False,
    max_partition_bytes: int | None = None,
    shuffle_partitions: int | None = None,
    settings: Mapping[str, str] | None = None,
) -> SparkSession.Builder:
    """Builder for a local or cluster session.

    On a cluster leave ``master`` unset so that spark-submit decides. The time
    zone is pinned because results are compared with zone-less timestamps.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master is not None:
        builder = builder.master(master)
    if hive:
        builder = builder.enableHiveSupport()
    if max_partition_bytes is not None:
        builder = builder.config("spark.sql.files.maxPartitionBytes", str(max_partition_bytes))
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return builder
