"""Equi-joins that keep their shape under hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.operators.grouping import CHUNK_ROWS, group_chunks
from weft.operators.hotkeys import (
    COPIED,
    HOT_ROWS,
    SALT,
    frequent_keys,
    heavy_hitters,
    ignored_rows,
    pieces,
    spread,
)
from weft.sources.scratch import stored

HOWS = ("inner", "left", "right", "full")


def equi_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    *,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Join on equal key columns; a null key matches nothing.

    The optimizer picks broadcast or sort-merge by size, and adaptive execution
    splits a key with very many rows in inner joins and on the preserved side of outer
    ones, so those are plain joins. What it cannot split is treated here: the other
    side of an outer join, and both sides of a full one. Their key columns are
    counted, and a key with more rows than ``hot_bound(...)`` is cut into pieces on
    its side and copied to each piece from the other; one that is hot on both sides is
    cut on both, and each pair of pieces meets once. Rows with null keys match nothing
    and are only cut. A copied row has a match somewhere, as its key has rows on the
    other side, so a copy that stays alone in its piece is dropped.

    ``hot_rows=None`` never looks for them.
    """
    if how not in HOWS:
        raise ValueError(f"how must be one of {HOWS}, not {how!r}")
    shared = (set(left.columns) & set(right.columns)) - set(on)
    if shared:
        raise ValueError(f"rename {sorted(shared)}, they are columns of both sides")
    for k in on:
        kinds = left.schema[k].dataType, right.schema[k].dataType
        if kinds[0] != kinds[1]:
            raise ValueError(f"key {k} has two types, {kinds[0]} and {kinds[1]}")
    sides = {"left": ["right"], "right": ["left"], "full": ["left", "right"]}.get(how, [])
    if hot_rows is None or not sides:
        return left.join(right, on, how)
    hot = _hot_keys(left, right, on, sides, hot_rows)
    if hot is None:
        return left.join(right, on, how)
    # Columns are numbered meanwhile, so that none has a name used here.
    a, b = _numbered(left, on, "a"), _numbered(right, on, "b")
    keys = [f"k{i}" for i in range(len(on))]
    pieces_left = spread(a, keys, hot, "_l", "_r").withColumnRenamed(COPIED, "_copied_left")
    pieces_right = spread(b, keys, hot, "_r", "_l").withColumnRenamed(COPIED, "_copied_right")
    joined = pieces_left.join(pieces_right, [*keys, "_l" + SALT, "_r" + SALT], how)
    # The mark of a side is null where that side has no row.
    alone_left = F.col("_copied_right").isNull() & F.col("_copied_left")
    alone_right = F.col("_copied_left").isNull() & F.col("_copied_right")
    kept = joined.filter(~F.coalesce(alone_left | alone_right, F.lit(False)))
    others = [(f"{mark}{i}", c) for f, mark in ((left, "a"), (right, "b")) for i, c in enumerate(f.columns) if c not in on]
    return kept.select(*[F.col(n).alias(c) for n, c in [*zip(keys, on), *others]])


def _numbered(df: DataFrame, on: list[str], mark: str) -> DataFrame:
    """``df`` with keys as ``k0``, ... and other columns by their place."""
    return df.select(
        *[F.col(f"`{c}`").alias(f"k{on.index(c)}" if c in on else f"{mark}{i}") for i, c in enumerate(df.columns)]
    )


def _hot_keys(
    left: DataFrame, right: DataFrame, on: list[str], sides: list[str], hot_rows: int
) -> DataFrame | None:
    """Hot keys with their pieces on both sides (``_l``, ``_r``), or None.

    The summaries are kept in scratch storage, as both sides must be cut alike.
    """
    spark = left.sparkSession
    found = [
        heavy_hitters(f, on, ignored=ignored_rows(hot_rows)).withColumn("_side", F.lit(name))
        for name, f in (("left", left), ("right", right))
        if name in sides
    ]
    both = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    names = [f"_k{i}" for i in range(len(on))]
    summary = stored(both, "frequent-keys")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot, bound, _ = frequent_keys(summary, ["_side", *names], partitions, hot_rows)
    if hot.isEmpty():
        return None
    side = {n: F.coalesce(F.max(F.when(F.col("_side") == n, F.col("_n"))), F.lit(0)) for n in ("left", "right")}
    return hot.groupBy(*names).agg(
        pieces(side["left"], bound).alias("_l"), pieces(side["right"], bound).alias("_r")
    )


def cogroup_chunks(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_value: str,
    right_value: str,
    *,
    chunk_rows: int = CHUNK_ROWS,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Both sides' sorted values per key: ``(keys, chunk, left, right)``.

    A key with more values than a chunk has further rows; a side without values
    has an empty array. Null keys of both sides meet in one group. The sides are
    combined by a group-by over chunks, each of which is at most two rows.
    """
    a = group_chunks(left, keys, left_value, chunk_rows=chunk_rows, hot_rows=hot_rows)
    b = group_chunks(right, keys, right_value, chunk_rows=chunk_rows, hot_rows=hot_rows)
    a = a.withColumnRenamed("values", "left")
    b = b.withColumnRenamed("values", "right")
    both = a.unionByName(b, allowMissingColumns=True).groupBy(*keys, "chunk")
    # A side has one chunk or none, and collecting skips the missing one.
    return both.agg(
        F.flatten(F.collect_list("left")).alias("left"),
        F.flatten(F.collect_list("right")).alias("right"),
    )
