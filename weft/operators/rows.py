"""Row-wise operators: schema checks, batch mapping, sampling, previews."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weft.functions.text import clipped


def schema_status(df: DataFrame, schema: T.StructType, *, name: str = "status") -> DataFrame:
    """Columns of ``schema``, matched by name, and whether the row fits it.

    A row with a null in a required field is ``rejected``, any other is ``ok``.
    Types may be widened. A missing column or a lossy conversion fails before
    anything runs.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} are missing")
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    unfit = F.lit(False)
    for field in schema.fields:
        if not field.nullable:
            unfit = unfit | F.col(field.name).isNull()
    status = F.when(unfit, "rejected").otherwise("ok")
    return df.to(nullable).withColumn(name, status)


def enforce_schema(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the schema, and the rows that do not."""
    marked = schema_status(df, schema, name="_status")
    return tuple(
        marked.filter(F.col("_status") == status).drop("_status") for status in ("ok", "rejected")
    )


def map_batches(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: T.StructType | str,
) -> DataFrame:
    """Apply ``function`` to the Arrow batches of every partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map(function, batches)

    return df.mapInArrow(run, schema)


def random_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Bernoulli sample without replacement; its size varies."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def hash_sample(df: DataFrame, key: str, fraction: float) -> DataFrame:
    """Sample that keeps the same keys for any partitioning or run.

    A null key is drawn like any other; at a fraction of 1 every row stays.
    """
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("\u0000")))
    draw = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return df.filter(draw < int(fraction * 2**32))


def preview(
    df: DataFrame,
    n: int = 20,
    *,
    order: list[str | Column] | None = None,
    width: int | None = 20,
    vertical: bool = False,
) -> DataFrame:
    """The first ``n`` rows as text, cut to ``width`` characters if given.

    ``vertical`` gives one row per cell: ``(row, field, value)``. Without
    ``order`` the rows are any ``n``.
    """
    head = df.orderBy(*order).limit(n) if order else df.limit(n)
    cells = [
        (clipped(F.col(f"`{c}`"), width) if width else F.col(f"`{c}`").cast("string")).alias(c)
        for c in df.columns
    ]
    if not vertical:
        return head.select(*cells)
    # The window sees n rows only.
    numbered = Window.orderBy(*order) if order else Window.orderBy(F.lit(0))
    rows = head.select(F.row_number().over(numbered).alias("_row"), *cells)
    fields = F.array(
        *[F.struct(F.lit(c).alias("field"), F.col(f"`{c}`").alias("value")) for c in df.columns]
    )
    return rows.select(F.col("_row").alias("row"), F.inline(fields))
