"""Grouped aggregates, group contents and column statistics."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weft.operators.hotkeys import HOT_ROWS, frequent_keys, heavy_hitters, ignored_rows
from weft.operators.keymarks import with_marks
from weft.operators.names import fresh
from weft.operators.ordering import quantile_table, running_totals, sketch_measures
from weft.operators.rowgroups import one_batch
from weft.sources.scratch import stored

CHUNK_ROWS = 10_000
CHUNK_BYTES = 64 << 20


def aggregate(
    df: DataFrame, keys: list[str], measures: Iterable[tuple[str, str, str]]
) -> DataFrame:
    """``(column, function, alias)`` measures. Unlike a mapping from column to
    function this keeps several functions of one column, and their order."""
    return df.groupBy(*keys).agg(*[getattr(F, fn)(c).alias(name) for c, fn, name in measures])


def reduce_by_key(
    df: DataFrame, keys: list[str], value: str, how: str, name: str, *, partitions: int | None = None
) -> DataFrame:
    """Reduce with a function that may be applied in any order; combined before
    the shuffle. No keys reduce the whole frame to one row. ``partitions`` bounds the
    number of reduce tasks."""
    if how not in ("sum", "min", "max", "bit_and", "bit_or", "bit_xor", "bool_and", "bool_or"):
        raise ValueError(f"{how!r} is not a known order-free reduction")
    reduced = aggregate(df, keys, [(value, how, name)])
    return reduced.coalesce(partitions) if partitions else reduced


def count_by_key(df: DataFrame, *keys: str | Column, name: str = "n") -> DataFrame:
    """Rows per key. Null is a key of its own."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def count_by_value(df: DataFrame, name: str = "n") -> DataFrame:
    """Occurrences of each whole row."""
    return count_by_key(df, *df.columns, name=name)


def group_chunks(
    df: DataFrame,
    keys: list[str],
    value: str,
    *,
    chunk_rows: int = CHUNK_ROWS,
    chunk_bytes: int = CHUNK_BYTES,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Sorted values per key: ``(keys, chunk, values)``, nulls first.

    A group of up to ``chunk_rows`` values is one row with chunk 0, a larger one goes
    on in further rows; chunk by chunk they are the whole sorted group. Values of more
    than ``chunk_bytes / chunk_rows`` bytes count as several, so a chunk has at most
    about ``chunk_bytes``; chunk numbers can then leave some out.

    Rows are exchanged once, by key, and sorted by key and value; a task cuts the chunks
    of one key after the other and holds one chunk. Keys with more rows than the bound of
    ``frequent_keys``, found by summaries of bounded size, would make a task large: their
    values are placed by running totals over ranges instead and gathered chunk by chunk.
    Either way gives the same chunks. ``hot_rows=None`` never looks for such keys.
    """
    v, cost, m1, m2 = fresh(keys, "v", "cost", "m1", "m2")
    pairs = df.select(*[F.col(f"`{k}`") for k in keys], F.col(value).alias(v))
    pairs = with_marks(pairs, keys, [m1, m2])
    pairs = pairs.withColumn(cost, _cost(F.col(v), pairs.schema[v].dataType, chunk_rows, chunk_bytes))
    cold, hot = pairs, None
    if hot_rows is not None:
        found = heavy_hitters(pairs, [m1, m2], ignored=ignored_rows(hot_rows))
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        frequent, _, _ = frequent_keys(stored(found, "frequent-keys"), ["_k0", "_k1"], partitions, hot_rows)
        if not frequent.isEmpty():
            # At most two per half of the bound; see frequent_keys.
            marks = F.broadcast(frequent.select(F.col("_k0").alias(m1), F.col("_k1").alias(m2)))
            cold, hot = pairs.join(marks, [m1, m2], "left_anti"), pairs.join(marks, [m1, m2], "left_semi")
    chunks = _cut(cold, keys, v, cost, [m1, m2], chunk_rows)
    if hot is None:
        return chunks
    return chunks.unionByName(_placed_chunks(hot, keys, v, cost, chunk_rows))


def _cut(
    pairs: DataFrame, keys: list[str], v: str, cost: str, marks: list[str], chunk_rows: int
) -> DataFrame:
    """Chunks of keys that fit a task each, cut from sorted rows as they stream by."""
    laid = pairs.repartition(*marks).sortWithinPartitions(*marks, v)
    values = T.ArrayType(pairs.schema[v].dataType)
    schema = T.StructType(
        [*[pairs.schema[k] for k in keys], T.StructField("chunk", T.LongType()), T.StructField("values", values)]
    )
    width = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, begun = None, 0  # the rows of an open chunk, and where it begins in its key

        def rows(batch, places, starts, stops):
            values = batch.column(width + 3)
            bounds = pa.array(np.r_[starts, stops[-1:]].astype(np.int32))
            lists = pa.ListArray.from_arrays(bounds, values)
            firsts = pa.array(starts)
            number = pa.array(places[starts] // chunk_rows)
            return pa.RecordBatch.from_arrays([*[c.take(firsts) for c in batch.columns[:width]], number, lists], schema.names)

        for batch in batches:
            if not batch.num_rows:
                continue
            batch = batch if held is None else one_batch([held, batch])
            a, b, weight = (batch.column(width + i).to_numpy() for i in range(3))
            new = np.ones(batch.num_rows, bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            before = np.cumsum(weight) - weight
            firsts = np.flatnonzero(new)
            lengths = np.diff(np.r_[firsts, len(new)])
            places = before - np.repeat(before[firsts], lengths)
            # The first key goes on where its held chunk began.
            places[: lengths[0]] += begun if held is not None else 0
            number = places // chunk_rows
            new[1:] |= number[1:] != number[:-1]
            starts = np.flatnonzero(new)
            last = int(starts[-1])
            if last:
                yield rows(batch, places, starts[:-1], starts[1:])
            held, begun = batch.slice(last), int(places[last])
        if held is not None:
            places = np.array([begun])
            yield rows(held, places, np.array([0]), np.array([held.num_rows]))

    return laid.select(*[F.col(f"`{k}`") for k in keys], *marks, cost, v).mapInArrow(run, schema)


def _placed_chunks(pairs: DataFrame, keys: list[str], v: str, cost: str, chunk_rows: int) -> DataFrame:
    """Chunks of keys of any size: values are placed by ranges, then meet by chunk."""
    at, group, pair = fresh(pairs.columns, "at", "group", "pair")
    named = [F.col(f"`{k}`") for k in keys]
    placed = running_totals(pairs.select(*named, v, cost), keys, [v], cost, name=at)
    chunk = F.expr(f"{at} div {chunk_rows}").alias("chunk")
    given = placed.select(*[n.alias(f"{group}{i}") for i, n in enumerate(named)], chunk, F.struct(at, v).alias(pair))
    marks = [f"{group}{i}" for i in range(len(keys))]
    # Places differ, so sorting by them never compares values.
    gathered = given.groupBy(*marks, "chunk").agg(F.sort_array(F.collect_list(pair)).alias(pair))
    return gathered.select(
        *[F.col(m).alias(k) for m, k in zip(marks, keys)], "chunk", F.col(pair)[v].alias("values")
    )


def _cost(value: Column, kind: T.DataType, chunk_rows: int, chunk_bytes: int) -> Column:
    """How many ordinary values a value counts for by its size."""
    size = _size(value, kind)
    if size is None:
        return F.lit(1).cast("long")
    wide = F.ceil(size.cast("double") * chunk_rows / chunk_bytes).cast("long")
    return F.greatest(F.lit(1).cast("long"), F.coalesce(wide, F.lit(1)))


def _size(value: Column, kind: T.DataType) -> Column | None:
    """Bytes of what has no fixed size in a value; None if all of it has."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)).cast("long")
    if isinstance(kind, T.StructType):
        sizes = [s for s in (_size(value[f.name], f.dataType) for f in kind.fields) if s is not None]
        return functools.reduce(lambda a, b: a + b, sizes) if sizes else None
    if isinstance(kind, T.ArrayType):
        zero = F.lit(0).cast("long")
        each = lambda x: F.lit(8) if (s := _size(x, kind.elementType)) is None else s + 8
        return F.coalesce(F.aggregate(value, zero, lambda a, x: a + each(x)), zero)
    if isinstance(kind, T.MapType):
        return F.octet_length(F.to_json(F.struct(value))).cast("long")
    return None


def group_rows_by(
    df: DataFrame,
    key: Column,
    *,
    name: str = "key",
    chunk_rows: int = CHUNK_ROWS,
    chunk_bytes: int = CHUNK_BYTES,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Whole rows, as structs, grouped by a computed key; see group_chunks."""
    (row,) = fresh([name], "row")
    rows = df.select(key.alias(name), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(row))
    sizes = {"chunk_rows": chunk_rows, "chunk_bytes": chunk_bytes, "hot_rows": hot_rows}
    return group_chunks(rows, [name], row, **sizes)


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum, one row per column.

    Strings have no mean or deviation. All columns are measured in one pass.
    """
    return df.agg(F.array(*_descriptions(df, columns)).alias("rows")).select(F.inline("rows"))


def _descriptions(df: DataFrame, columns: list[str]) -> list[Column]:
    rows = []
    for c in columns:
        number = isinstance(df.schema[c].dataType, T.NumericType)
        mean, sd = (F.avg(c), F.stddev_samp(c)) if number else (F.lit(None), F.lit(None))
        rows.append(
            F.struct(
                F.lit(c).alias("field"),
                F.count(c).alias("n"),
                mean.cast("double").alias("mean"),
                sd.cast("double").alias("sd"),
                F.min(c).cast("string").alias("lowest"),
                F.max(c).cast("string").alias("highest"),
            )
        )
    return rows


def summary(
    df: DataFrame,
    columns: list[str],
    shares: dict[str, float] | None = None,
    *,
    exact: bool = True,
) -> DataFrame:
    """:func:`describe` with quantiles, as text; one row per column.

    Strings have no quantiles. The number of scans does not depend on the number of
    columns: one measures the columns and sketches them, and exact quantiles take one
    more (see quantile_table). Approximate ones (``exact=False``, Spark's
    ``percentile_approx``) take a scan of their own.
    """
    shares = shares or {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    numbers = [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)]
    described = describe(df, columns)
    if not numbers:
        return described.select("*", *[F.lit(None).cast("string").alias(q) for q in shares])
    if exact:
        rows = [F.array(*_descriptions(df, columns)).alias("d"), F.array(*sketch_measures(df, numbers)).alias("s")]
        first = stored(df.agg(*rows), "summary")  # one row
        described = first.select(F.inline("d"))
        table = quantile_table(df, numbers, shares, sketches=first.select(F.inline("s")))
        texts = [
            F.coalesce(*[c.cast("string") for c in _fields(table, q)]).alias(q) for q in shares
        ]
        table = table.select("field", *texts)
    else:
        at = F.array(*[F.lit(float(s)) for s in shares.values()])
        cells = []
        for i, c in enumerate(numbers):
            found = F.percentile_approx(c, at).cast("array<string>").alias("_q")
            cells.append(F.struct(F.lit(c).alias("field"), found).alias(f"_{i}"))
        rows = df.agg(*cells).select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(cells))])))
        table = rows.select("field", *[F.col("_q")[j].alias(q) for j, q in enumerate(shares)])
    # One row per column on both sides.
    return described.join(F.broadcast(table), "field", "left")


def _fields(table: DataFrame, column: str) -> list[Column]:
    return [F.col(f"{column}.{f.name}") for f in table.schema[column].dataType.fields]
