"""Aggregate expressions with the empty-input rules of hand-written aggregates.

All are built from Spark aggregates, so they combine before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_values(c: str) -> Column:
    """Number of non-null values."""
    return F.count(c)


def sum_or_zero(c: str | Column) -> Column:
    """Sum of non-null values; 0, not null, when there are none."""
    return F.coalesce(F.sum(c), F.lit(0))


def max_or_zero(c: str | Column) -> Column:
    """Maximum that starts at 0: never below 0, and 0 when there are no values."""
    return F.greatest(F.coalesce(F.max(c), F.lit(0)), F.lit(0))


def average_or_nan(c: str | Column) -> Column:
    """Double average of non-null values; NaN, not null, when there are none."""
    return F.coalesce(F.avg(c), F.lit(float("nan")))


def whole_average(c: str) -> Column:
    """Integer average, cut toward zero; null when there are no values."""
    return F.expr(f"sum(`{c}`) div nullif(count(`{c}`), 0)")


NEUTRAL = {"sum": 0, "count": 0}


def fold(c: str, how: str = "sum", zero=0) -> Column:
    """Fold a column from a start value.

    The start value enters once per partition, so only a neutral one gives a
    result that does not depend on the partitioning; any other is refused.
    """
    if how not in NEUTRAL:
        raise ValueError(f"fold knows {sorted(NEUTRAL)}, not {how!r}")
    if zero != NEUTRAL[how]:
        raise ValueError(f"{zero!r} is not neutral for {how}; the result would vary")
    return F.coalesce(getattr(F, how)(c), F.lit(zero))
