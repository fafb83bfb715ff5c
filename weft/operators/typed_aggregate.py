"""User-defined aggregates in Python with a combine step before the shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weft.operators.keymarks import with_marks
from weft.operators.names import fresh
from weft.operators.rowgroups import group_numbers, one_batch

HELD_ROWS = 100_000
LEVEL = 1024  # buffers of a whole frame are merged by so many tasks, then by one


@dataclass(frozen=True)
class Aggregator:
    """An aggregate given by its buffer.

    ``reduce`` adds an Arrow array of one key's values to a buffer, ``merge``
    joins two buffers in any order, ``finish`` turns one into the result.
    Buffers are tuples that fit the ``buffer`` schema.

    The three optional functions do the same for all keys of a batch at once, on
    Arrow columns, which matters when keys are many: ``reduce_groups(values, groups,
    n)`` and ``merge_groups(columns, groups, n)`` give the buffer columns of ``n``
    groups, where ``groups`` has the group number of each row, and
    ``finish_groups(columns)`` gives the result column.
    """

    buffer: str
    result: str
    zero: Callable[[], tuple]
    reduce: Callable[[tuple, pa.Array], tuple]
    merge: Callable[[tuple, tuple], tuple]
    finish: Callable[[tuple], Any]
    reduce_groups: Callable[[pa.Array, np.ndarray, int], list[pa.Array]] | None = None
    merge_groups: Callable[[list[pa.Array], np.ndarray, int], list[pa.Array]] | None = None
    finish_groups: Callable[[list[pa.Array]], pa.Array] | None = None

    def reduced(self, values: pa.Array, groups: np.ndarray, n: int, kinds: list) -> list[pa.Array]:
        if self.reduce_groups:
            return self.reduce_groups(values, groups, n)
        order = np.argsort(groups, kind="stable")
        values = values.take(pa.array(order))
        bounds = np.searchsorted(groups[order], np.arange(n + 1))
        rows = [self.reduce(self.zero(), values.slice(a, b - a)) for a, b in zip(bounds, bounds[1:])]
        return [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]

    def merged(self, columns: list[pa.Array], groups: np.ndarray, n: int, kinds: list) -> list[pa.Array]:
        if self.merge_groups:
            return self.merge_groups(columns, groups, n)
        rows: list = [None] * n
        for group, part in zip(groups.tolist(), zip(*[c.to_pylist() for c in columns])):
            rows[group] = part if rows[group] is None else self.merge(rows[group], part)
        return [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]

    def finished(self, columns: list[pa.Array], kind) -> pa.Array:
        if self.finish_groups:
            return self.finish_groups(columns)
        return pa.array([self.finish(b) for b in zip(*[c.to_pylist() for c in columns])], kind)


def aggregate_with(
    df: DataFrame, keys: list[str], value: str, aggregator: Aggregator, *, name: str = "result"
) -> DataFrame:
    """Aggregate ``value`` per key; with no keys, one row for the whole frame.

    Each task reduces its batches to one buffer per key, which is merged with those
    of earlier batches while there are not too many. The buffers are shuffled and
    sorted by key and merged in a stream, so no task holds a whole group; a hot key
    costs one buffer per task that saw it. Buffers of a whole frame are merged in two
    levels. Keys of any type that Spark groups by are allowed; they are told apart by
    marks (see with_marks), and key columns are passed through as they are.
    """
    spark = df.sparkSession
    buffer = T.StructType.fromDDL(aggregator.buffer).fields
    result = T.StructType.fromDDL(f"r {aggregator.result}").fields[0].dataType
    # Column names do not matter in between, so that none can clash.
    mark, other, held_value, level_name, *held_names = fresh(
        keys, "m1", "m2", "value", "level", *[f"b{i}" for i in range(len(buffer))]
    )
    marks = [T.StructField(mark, T.LongType()), T.StructField(other, T.IntegerType())]
    key_fields = [df.schema[k] for k in keys]
    held_fields = [T.StructField(n, f.dataType) for n, f in zip(held_names, buffer)]
    partial = T.StructType([*key_fields, *marks, *held_fields])
    final = T.StructType([*key_fields, T.StructField(name, result)])
    width = len(keys)
    # Arrow's names of the types, from an empty frame.
    types = T.StructType([*held_fields, T.StructField("r", result)])
    *kinds, result_kind = spark.createDataFrame([], types).toArrow().schema.types

    def batch_of(head: list, columns: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*head, *columns], partial.names)

    def collapsed(batch: pa.RecordBatch) -> pa.RecordBatch:
        """One row for each key of a batch of buffers."""
        groups, firsts = group_numbers(batch.column(width), batch.column(width + 1))
        head = [c.take(firsts) for c in batch.columns[: width + 2]]
        return batch_of(head, aggregator.merged(batch.columns[width + 2 :], groups, len(firsts), kinds))

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, fresh = [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            groups, firsts = group_numbers(batch.column(width), batch.column(width + 1))
            head = [c.take(firsts) for c in batch.columns[: width + 2]]
            values = batch.column(width + 2)
            held.append(batch_of(head, aggregator.reduced(values, groups, len(firsts), kinds)))
            rows += len(firsts)
            fresh += 1
            if rows >= HELD_ROWS or fresh >= 64:
                held, fresh = [collapsed(one_batch(held))], 0
                rows = held[0].num_rows
                if rows >= HELD_ROWS // 2:
                    yield held[0]
                    held, rows = [], 0
        if held:
            yield collapsed(one_batch(held))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Buffers in the order of their keys; the last key waits for the next batch."""
        held = None
        for batch in batches:
            if batch.num_rows:
                whole = collapsed(batch if held is None else one_batch([held, batch]))
                held = whole.slice(whole.num_rows - 1)
                yield whole.slice(0, whole.num_rows - 1)
        if held is not None:
            yield held

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in merge(batches):
            seen += batch.num_rows
            column = aggregator.finished(batch.columns[width + 2 :], result_kind)
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], column], final.names)
        if not keys and not seen:
            empty = pa.array([aggregator.finish(aggregator.zero())], result_kind)
            yield pa.RecordBatch.from_arrays([empty], final.names)

    columns = [F.col(f"`{k}`") for k in keys]
    given = df.select(*columns, F.col(f"`{value}`").alias(held_value))
    given = with_marks(given, keys, [mark, other]).select(*columns, mark, other, held_value)
    buffers = given.mapInArrow(combine, partial)
    if keys:
        buffers = buffers.repartition(mark, other).sortWithinPartitions(mark, other)
    else:
        level = F.pmod(F.spark_partition_id(), F.lit(LEVEL))
        buffers = buffers.withColumn(level_name, level).repartition(level_name).drop(level_name)
        buffers = buffers.mapInArrow(merge, partial).repartition(1)
    return buffers.mapInArrow(finish, final)


def average() -> Aggregator:
    """Double average over a (sum, count) buffer; NaN without values.

    Values are summed as doubles, so a sum of longs cannot wrap.
    """

    def floats(values: pa.Array) -> np.ndarray:
        return pc.cast(values, pa.float64(), safe=False).to_numpy(zero_copy_only=False)

    def reduce(buffer, values):
        present = floats(values.drop_null())
        return buffer[0] + float(present.sum()), buffer[1] + len(present)

    def reduce_groups(values, groups, n):
        present = values.is_valid().to_numpy(zero_copy_only=False)
        groups, kept = groups[present], floats(values.drop_null())
        return [pa.array(np.bincount(groups, kept, n)), pa.array(np.bincount(groups, minlength=n))]

    def merge_groups(columns, groups, n):
        total = np.bincount(groups, columns[0].to_numpy(), n)
        # Counts below 2^53 are exact as doubles.
        count = np.bincount(groups, columns[1].to_numpy().astype(float), n)
        return [pa.array(total), pa.array(count.astype(np.int64))]

    def finish_groups(columns):
        total, count = columns[0].to_numpy(), columns[1].to_numpy()
        return pa.array(np.where(count > 0, total / np.maximum(count, 1), np.nan))

    return Aggregator(
        buffer="total double, n long",
        result="double",
        zero=lambda: (0.0, 0),
        reduce=reduce,
        merge=lambda a, b: (a[0] + b[0], a[1] + b[1]),
        finish=lambda b: b[0] / b[1] if b[1] else float("nan"),
        reduce_groups=reduce_groups,
        merge_groups=merge_groups,
        finish_groups=finish_groups,
    )
