"""Managed, bucketed tables in the session catalog."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from weft.sources.scratch import scratch_path, stored

BUCKET_BYTES = 256 << 20
MOST_BUCKETS = 100_000  # of spark.sql.sources.bucketing.maxBuckets


def scratch_database(spark: SparkSession, name: str = "weft_scratch") -> str:
    """A database whose managed tables live in the shared scratch folder."""
    if not spark.catalog.databaseExists(name):
        location = scratch_path(spark, "database")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")
    return name


class ScratchTables:
    """Owner of tables for one result: they are dropped when the result is written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.database, self.names = spark, scratch_database(spark), []

    def name(self, label: str) -> str:
        """A fresh table name that this owner drops."""
        self.names.append(f"{self.database}.{label}_{uuid.uuid4().hex[:12]}")
        return self.names[-1]

    def result(self, df: DataFrame) -> DataFrame:
        """``df`` written to scratch storage, so that it outlives the tables."""
        return stored(df, "result")

    def drop(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.names = []


@contextlib.contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[ScratchTables]:
    tables = ScratchTables(spark)
    try:
        yield tables
    finally:
        tables.drop()


def truncate(spark: SparkSession, table: str) -> None:
    """Removes all rows; the table stays."""
    spark.sql(f"TRUNCATE TABLE {table}")


def bucket_count(data_bytes: int, *, bucket_bytes: int = BUCKET_BYTES, most: int = MOST_BUCKETS) -> int:
    """Buckets of about ``bucket_bytes``, within what Spark takes.

    Not the number of shuffle partitions, which can be above Spark's limit.
    """
    return max(1, min(most, -(-data_bytes // bucket_bytes)))


def create_table(spark: SparkSession, table: str, columns: str) -> str:
    """Empty managed table from a column list in SQL; kept if it exists."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet")
    return table


def insert(df: DataFrame, table: str) -> DataFrame:
    """Append rows, columns by name."""
    target = df.sparkSession.table(table)
    df.select(*target.columns).write.insertInto(table)
    return df.sparkSession.table(table)


def save_table(df: DataFrame, table: str, *, mode: str = "error") -> DataFrame:
    df.write.mode(mode).saveAsTable(table)
    return df.sparkSession.table(table)


def save_bucketed(
    df: DataFrame,
    table: str,
    keys: list[str],
    buckets: int,
    *,
    sort: list[str] | None = None,
    mode: str = "error",
) -> DataFrame:
    """Bucketed table with one file per bucket.

    Rows are hashed to the buckets before the write; without that every task
    would add a file of its own to every bucket.
    """
    placed = df.repartition(buckets, *keys)
    writer = placed.write.mode(mode).bucketBy(buckets, *keys)
    writer.sortBy(*(sort or keys)).saveAsTable(table)
    return df.sparkSession.table(table)


#: Lets the planner use that a bucket of one file is sorted.
SORTED_BUCKETS = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def merge_buckets(
    spark: SparkSession, left: str, right: str, keys: list[str], how: str = "inner"
) -> DataFrame:
    """Join of two tables of :func:`save_bucketed` on their bucket and sort columns.

    Buckets have one file each and are sorted, so they are merged as they are read, with
    neither an exchange nor a sort. Both tables need the same number of buckets. The
    plan belongs to a session of its own, as it takes a setting that other scans need
    not have.
    """
    session = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        session.conf.set(key, spark.conf.get(key))
    session.conf.set(SORTED_BUCKETS, "true")
    return session.table(left).join(session.table(right).hint("merge"), keys, how)
