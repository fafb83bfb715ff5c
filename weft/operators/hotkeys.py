"""Keys that hold too many rows for one task, and ways to treat them apart."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weft.operators.keymarks import with_marks
from weft.operators.rowgroups import group_numbers, one_batch

HOT_ROWS = 1_000_000
COUNTERS = 65_536  # most keys that a task counts at once, and returns
PARTS = 8  # of an average partition; a key with fewer rows than one is never hot
SALT = "_salt"
COPIED = "_copied"


def hot_bound(total: int, partitions: int, hot_rows: int = HOT_ROWS) -> int:
    """Rows above which a key is hot: ``hot_rows``, or a part of an average shuffle
    partition if that is more. So at most PARTS keys per partition are hot."""
    return max(hot_rows, -(-total // (PARTS * partitions)))


def heavy_hitters(
    df: DataFrame, keys: list[str], *, counters: int = COUNTERS, ignored: int = 0
) -> DataFrame:
    """Counts of the frequent keys, per task: ``_k0``, ..., the marks ``_m1`` and ``_m2``,
    ``_n``, ``_rows``, ``_missed``.

    A Misra-Gries summary: a task counts at most ``counters`` keys, and when there are
    more it takes the next largest count off all of them and forgets those that reach
    zero. At the end it leaves out keys of at most ``ignored`` rows, or of so few that
    ``counters`` of them would be all its rows. Summaries are merged by adding: a key's
    ``_n`` in all of them is at most its rows, and at least its rows less the sum of
    ``_missed``. One row per task, with null marks, has its ``_rows`` and ``_missed``.
    """
    named = df.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)])
    width = len(keys)
    marked = with_marks(named, named.columns, ["_m1", "_m2"])
    schema = T.StructType(
        [
            *[T.StructField(f.name, f.dataType) for f in named.schema.fields],
            *T.StructType.fromDDL("_m1 long, _m2 int, _n long, _rows long, _missed long").fields,
        ]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, fresh, rows, missed, kinds = [], 0, 0, 0, None

        def collapsed(parts: list) -> tuple[pa.RecordBatch, np.ndarray]:
            nonlocal missed
            batch = one_batch([b for b, _ in parts])
            groups, firsts = group_numbers(batch.column(width), batch.column(width + 1))
            counts = np.zeros(len(firsts), np.int64)
            np.add.at(counts, groups, np.concatenate([n for _, n in parts]))
            if len(counts) > counters:
                off = int(np.partition(counts, -counters - 1)[-counters - 1])
                missed += off
                counts -= off
            stay = np.flatnonzero(counts > 0)
            return batch.take(firsts.take(pa.array(stay))), counts[stay]

        for batch in batches:
            kinds = batch.schema
            if not batch.num_rows:
                continue
            rows += batch.num_rows
            groups, firsts = group_numbers(batch.column(width), batch.column(width + 1))
            held.append((batch.take(firsts), np.bincount(groups, minlength=len(firsts))))
            fresh += len(firsts)
            if fresh > counters:
                held, fresh = [collapsed(held)], 0
        if not rows:
            return
        batch, counts = collapsed(held)
        few = max(ignored, rows // counters)
        stay = np.flatnonzero(counts > few)
        missed += few if len(stay) < len(counts) else 0
        batch, counts = batch.take(pa.array(stay)), counts[stay]
        longs = [pa.array(counts), pa.nulls(len(counts), pa.int64()), pa.nulls(len(counts), pa.int64())]
        yield pa.RecordBatch.from_arrays([*batch.columns, *longs], schema.names)
        none = [pa.nulls(1, f.type) for f in kinds]
        totals = [pa.nulls(1, pa.int64()), pa.array([rows]), pa.array([missed])]
        yield pa.RecordBatch.from_arrays([*none, *totals], schema.names)

    return marked.mapInArrow(count, schema)


def frequent_keys(
    summary: DataFrame, names: list[str], partitions: int, hot_rows: int
) -> tuple[DataFrame, int, int]:
    """Merges a stored summary (see heavy_hitters): the keys with more than ``bound``
    rows as ``(names, _n)``, the bound, and all rows.

    ``names`` are the columns to group by. The bound is ``hot_bound(...)``, or twice what
    the summaries can have missed if that is more, so that every key above it is there,
    none with less than half as many rows is, and ``_n`` is at least its rows.
    """
    totals = summary.agg(F.sum("_rows").alias("t"), F.sum("_missed").alias("m")).first()
    total, missed = totals["t"] or 0, totals["m"] or 0
    bound = max(hot_bound(total, partitions, hot_rows), 2 * missed)
    counts = summary.filter("_n IS NOT NULL").groupBy(*names).agg((F.sum("_n") + missed).alias("_n"))
    return counts.filter(F.col("_n") > bound), bound, total


def ignored_rows(hot_rows: int) -> int:
    """Rows of a key in one task that do not matter where only more than ``hot_rows``
    in all tasks do."""
    return hot_rows >> 17


def pieces(count: Column, bound: int) -> Column:
    """How many pieces to cut a key into; no piece has more than about ``bound`` rows."""
    wanted = F.ceil(count / F.lit(max(1, bound))).cast("int")
    return F.when(count > bound, F.greatest(wanted, F.lit(2))).otherwise(1)


def _holds_map(kind: T.DataType) -> bool:
    """Maps have no hash."""
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType)


def spread(df: DataFrame, keys: list[str], hot: DataFrame, cut: str, copy: str) -> DataFrame:
    """Adds a salt: of a key in ``hot`` a row goes to one of ``cut`` pieces on its own
    side, and to each of the ``copy`` pieces of the other side. Copied rows are marked.
    A row with a null in its key is never copied, as it joins with nothing.

    ``hot`` has ``_k0``, ... and the columns ``cut`` and ``copy``, at most PARTS rows
    per shuffle partition (see hot_bound), so it may be broadcast. The salt is a pair
    (piece of the first side, piece of the second). The piece depends on the row and
    its partition, not on chance: a task that runs again places its rows alike, and
    equal rows still spread.
    """
    same, null = F.lit(True), F.lit(False)
    for i, k in enumerate(keys):
        same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"_k{i}"))
        null = null | F.col(f"`{k}`").isNull()
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if not _holds_map(f.dataType)]
    mark = F.xxhash64(F.spark_partition_id(), *hashed)
    own = F.pmod(mark, F.coalesce(F.col(cut), F.lit(1))).cast("int")
    copies = F.when(null, F.lit(1)).otherwise(F.coalesce(F.col(copy), F.lit(1)))
    joined = df.join(F.broadcast(hot.select(*[f"_k{i}" for i in range(len(keys))], cut, copy)), same, "left")
    return joined.select(
        *df.columns,
        (copies > 1).alias(COPIED),
        own.alias(cut + SALT),
        F.explode(F.sequence(F.lit(0), copies - 1)).alias(copy + SALT),
    )
