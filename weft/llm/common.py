"""What several operators of this folder share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weft.sources.scratch import scratch_path

#: Rows worked on at once in Python, whatever size of Arrow batch the session sets.
BATCH_ROWS = 1000

#: White space of the text rules, as characters and as a regular expression.
SPACE = r"[\x20\x09-\x0D]"


def held(name: str, build: Callable):
    """The value of ``build()``, made once per Python process.

    Functions travel by value, so their own globals are new in every task; what
    is costly to build is kept in a module that only lives in the process.
    """
    store = sys.modules.setdefault("_weft_llm_held", types.ModuleType("_weft_llm_held")).__dict__
    if name not in store:
        store[name] = build()
    return store[name]


class Memo(dict):
    """A dict that computes missing values and keeps at most 2 x ``size`` of them.

    When it is full it becomes the old generation; a value found there moves over,
    so that frequent keys stay.
    """

    def __init__(self, compute: Callable, size: int):
        super().__init__()
        self.compute, self.size, self.old = compute, size, {}

    def __missing__(self, key):
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        self[key] = value
        return value


def map_rows(
    df: DataFrame,
    inputs: list[str],
    outputs: str,
    function: Callable[..., list[pa.Array]],
    *,
    keep: list[str] | None = None,
) -> DataFrame:
    """Adds columns made from Arrow batches of ``inputs``, row by row.

    ``function`` gets the input arrays and returns an array for each field of the
    ``outputs`` schema. ``keep`` names the columns that stay (default: all); one
    named like an output gives way to it, whatever its case.
    """
    made = T.StructType.fromDDL(outputs)
    taken = {f.name.lower() for f in made.fields}
    stay = [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]
    schema = T.StructType([*[df.schema[c] for c in stay], *made.fields])
    width = len(stay)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                columns = function(*batch.columns[width:])
                yield pa.RecordBatch.from_arrays([*batch.columns[:width], *columns], schema.names)

    picked = [F.col(f"`{c}`") for c in stay]
    mark = "_" * (1 + max(map(len, stay), default=0))  # longer than any name that stays
    given = [F.col(f"`{c}`").alias(f"{mark}{i}") for i, c in enumerate(inputs)]
    return df.select(*picked, *given).mapInArrow(run, schema)


def utf8(column: pa.Array) -> tuple[bytes, list[int]]:
    """All texts of a batch as one buffer with their bounds; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    first = column.offset
    bounds = np.frombuffer(column.buffers()[1], np.int64)[first : first + len(column) + 1]
    data = column.buffers()[2]
    low, high = int(bounds[0]), int(bounds[-1])
    return (data[low:high].to_pybytes() if data else b""), (bounds - low).tolist()


def id_remainder(column: str, divisor: int) -> Column:
    """crc32 of an id as text, modulo ``divisor``; null for a null id."""
    return F.crc32(F.col(f"`{column}`").cast("string").cast("binary")) % divisor


def uniform(*columns: str, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the values only."""
    mixed = F.xxhash64(*[F.col(f"`{c}`") for c in columns], F.lit(seed))
    return F.pmod(mixed, F.lit(1 << 40)) / float(1 << 40)


def kept(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared scratch folder, and a scan of the files.

    Python stages are costly and ranges may be cut anew by another run of the same
    plan; what two passes read is therefore written. Lost executors lose nothing.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
