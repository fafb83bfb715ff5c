"""Schemas taken from record classes."""

from __future__ import annotations

import dataclasses
import types
import typing

from pyspark.sql import types as T

SIMPLE = {
    str: T.StringType(),
    int: T.LongType(),
    float: T.DoubleType(),
    bool: T.BooleanType(),
}


def record_schema(record: type) -> T.StructType:
    """Schema of a dataclass.

    Numbers and booleans are required unless they are optional; text and lists
    may always be null.
    """
    hints = typing.get_type_hints(record)
    return T.StructType([_field(f.name, hints[f.name]) for f in dataclasses.fields(record)])


def _field(name: str, hint) -> T.StructField:
    optional = False
    if typing.get_origin(hint) in (typing.Union, types.UnionType):
        kinds = [a for a in typing.get_args(hint) if a is not type(None)]
        if len(kinds) != 1:
            raise TypeError(f"{name} has several types")
        hint, optional = kinds[0], True
    kind = _type(name, hint)
    required = isinstance(kind, (T.NumericType, T.BooleanType)) and not optional
    return T.StructField(name, kind, not required)


def _type(name: str, hint) -> T.DataType:
    if typing.get_origin(hint) is list:
        return T.ArrayType(_type(name, typing.get_args(hint)[0]))
    if dataclasses.is_dataclass(hint):
        return record_schema(hint)
    if hint not in SIMPLE:
        raise TypeError(f"{name}: {hint} has no column type")
    return SIMPLE[hint]
