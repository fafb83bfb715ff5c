"""Parquet table directories and the views made from them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def load_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def widened(df: DataFrame) -> DataFrame:
    """Spreads a scan of fewer splits than the cluster has cores.

    For costly work per row on a table that comes as one or a few large pieces.
    A table of many files has enough splits and is left alone. ``df`` should be a
    scan, as asking for its splits runs any shuffle in it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def register_tables(
    spark: SparkSession, directory: str, names: Iterable[str] = TABLES, *, prefix: str = ""
) -> list[str]:
    """Session temp views over a table directory; returns the view names."""
    views = []
    for name in names:
        view = f"{prefix}{name}"
        load_table(spark, directory, name).createOrReplaceTempView(view)
        views.append(view)
    return views


def query_global_view(df: DataFrame, view: str, sql: str) -> DataFrame:
    """Publish ``df`` as ``global_temp.<view>`` and query it from a new session."""
    df.createOrReplaceGlobalTempView(view)
    return df.sparkSession.newSession().sql(sql)


def sql_on_file(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.sql(f"SELECT * FROM {fmt}.`{path}`")
