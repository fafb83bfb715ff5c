"""Marks that tell keys of any type apart in Arrow batches: 96 bits of hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weft.operators.names import fresh

def with_marks(df: DataFrame, keys: list[str], marks: list[str]) -> DataFrame:
    """Adds the two ``marks``, a long and an int, equal for rows whose keys are one group.

    Signed zeros are one key and NaN is one, as in a grouping, and maps are equal
    whatever the order of their entries. Spark's hashes skip nulls, so whether a part is
    null and how long an array is are hashed as well. They also ignore collations: a key
    under one is first replaced by the least of the texts that are equal to it, which
    takes a join.
    """
    first, second = marks
    if not keys:
        return df.withColumns({first: F.lit(0).cast("long"), second: F.lit(0)})
    collated = has_collation(df, keys)
    names = keys
    if collated:
        names = fresh(df.columns, *[f"rep{i}" for i in range(len(keys))])
        least, *ends = fresh(df.columns, "least", *[f"q{i}" for i in range(len(keys))])
        plain = [F.col(f"`{k}`").cast(_binary(df.schema[k].dataType)) for k in keys]
        lowest = F.min(F.struct(*[c.alias(n) for c, n in zip(plain, names)])).alias(least)
        groups = df.groupBy(*[F.col(f"`{k}`").alias(q) for k, q in zip(keys, ends)])
        reps = groups.agg(lowest).select(*ends, f"{least}.*")
        same = F.lit(True)
        for k, q in zip(keys, ends):
            same = same & F.col(f"`{k}`").eqNullSafe(F.col(q))
        df = df.join(reps, same).drop(*ends)
    parts = [p for n in names for p in _parts(F.col(f"`{n}`"), df.schema[n].dataType)]
    marked = df.withColumns({first: F.xxhash64(*parts), second: F.hash(*parts)})
    return marked.drop(*names) if collated else marked


def _parts(column: Column, kind: T.DataType) -> list[Column]:
    """What to hash of a value, so that different values differ."""
    if isinstance(kind, T.StructType):
        return [column.isNull(), *[p for f in kind.fields for p in _parts(column[f.name], f.dataType)]]
    if isinstance(kind, T.ArrayType):
        elements = F.transform(column, lambda x: F.xxhash64(*_parts(x, kind.elementType)))
        return [column.isNull(), F.size(column), elements]
    if isinstance(kind, T.MapType):
        # Marks of the entries, sorted, as keys and values of any type can be marked.
        entries = F.transform(
            F.map_entries(column),
            lambda e: F.xxhash64(*_parts(e["key"], kind.keyType), *_parts(e["value"], kind.valueType)),
        )
        return [column.isNull(), F.size(column), F.array_sort(entries)]
    return [column.isNull(), column]


def has_collation(df: DataFrame, keys: list[str]) -> bool:
    """Whether marks of these keys take a join."""
    return any(_collated(df.schema[k].dataType) for k in keys)


def _collated(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_collated(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _collated(kind.elementType)
    if isinstance(kind, T.MapType):
        return _collated(kind.keyType) or _collated(kind.valueType)
    return isinstance(kind, T.StringType) and kind.collation != "UTF8_BINARY"


def _binary(kind: T.DataType) -> T.DataType:
    """The type with plain strings."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _binary(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_binary(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(_binary(kind.keyType), _binary(kind.valueType))
    return T.StringType() if isinstance(kind, T.StringType) else kind
