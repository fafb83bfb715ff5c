"""JDBC tables, read and written in parallel."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    column: str | None = None,
    bounds: tuple | None = None,
    partitions: int = 8,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Scan a table; with ``column`` the scan is cut into ranges of that column.

    Bounds only place the cuts, no row is lost outside them. When not given they
    are asked from the database in one small query.
    """
    props = dict(properties or {})
    if column is None:
        return spark.read.jdbc(url, table, properties=props)
    if bounds is None:
        ends = f"(SELECT min({column}) AS lo, max({column}) AS hi FROM {table}) ends"
        bounds = tuple(spark.read.jdbc(url, ends, properties=props).first())
    low, high = bounds
    if low is None or low == high:
        return spark.read.jdbc(url, table, properties=props)
    return spark.read.jdbc(
        url,
        table,
        column=column,
        lowerBound=low,
        upperBound=high,
        numPartitions=partitions,
        properties=props,
    )


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    *,
    mode: str = "error",
    connections: int = 8,
    batch_rows: int = 10_000,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Write with at most ``connections`` parallel connections."""
    writer = df.write.option("numPartitions", connections).option("batchsize", batch_rows)
    writer.jdbc(url, table, mode=mode, properties=dict(properties or {}))
