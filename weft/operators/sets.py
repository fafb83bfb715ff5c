"""Set operations on whole rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows, by position, duplicates kept."""
    return reduce(DataFrame.union, frames)


def intersection(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows found on both sides; nulls are equal.

    One group-by over both sides: copies collapse before the shuffle, and the
    rows are exchanged once.
    """
    sides = left.withColumn("_side", F.lit(1)).union(right.withColumn("_side", F.lit(2)))
    found = sides.groupBy(*left.columns).agg(F.bit_or("_side").alias("_sides"))
    return found.filter(F.col("_sides") == 3).drop("_sides")


def distinct(df: DataFrame, *columns: str) -> DataFrame:
    return (df.select(*columns) if columns else df).distinct()
