"""Functions registered by name for SQL.

SQL functions stay inside Catalyst and are the ones to prefer. The Python
variants get and give Arrow batches and show the user-defined surface.
"""

from __future__ import annotations

import datetime

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf, arrow_udtf, udtf


def register_sql_functions(spark: SparkSession) -> None:
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION str_length(x STRING) RETURNS INT RETURN length(x)"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION str_upper(x STRING) RETURNS STRING RETURN upper(x)"
    )


@arrow_udf(T.LongType())
def py_length(text: pa.Array) -> pa.Array:
    return pc.cast(pc.utf8_length(text), pa.int64())


@arrow_udf(T.StringType())
def py_upper(text: pa.Array) -> pa.Array:
    """Upper case with letters that become several, as in SQL's ``upper``."""
    return pa.array([None if t is None else t.upper() for t in text.to_pylist()], pa.string())


TOKEN = T.StructType(
    [T.StructField("pos", T.IntegerType()), T.StructField("word", T.StringType())]
)


@udtf(returnType=TOKEN, useArrow=True)
class Tokens:
    """``LATERAL tokens(text)``: the position and text of every word.

    Words are those of ``weft.functions.text.words``. Rows travel in Arrow batches;
    a function on whole batches (``arrow_udtf``) cannot be used laterally, see
    :func:`token_rows`.
    """

    def eval(self, text: str):
        if text is not None:
            kept = text.rstrip(" ")
            if kept or not text:
                yield from enumerate(kept.split(" "))


def token_rows(df: DataFrame, text: str) -> DataFrame:
    """``df`` without ``text``, once for each word of it, with ``pos`` and ``word``.

    A table function of a TABLE argument: it gets whole batches and cuts all their texts
    at once. Words as in :class:`Tokens`.
    """
    stay = [c for c in df.columns if c != text]
    schema = T.StructType([*[df.schema[c] for c in stay], *TOKEN.fields])

    @arrow_udtf(returnType=schema)
    class TokenRows:
        def eval(self, rows: pa.RecordBatch):
            batch = rows.column(text)
            kept = pc.utf8_rtrim(batch, " ")
            # A text of blanks only has no word, the empty text has an empty one.
            some = pc.fill_null(pc.or_(pc.not_equal(kept, ""), pc.equal(batch, "")), False)
            rows = rows.filter(some)
            lists = pc.split_pattern(kept.filter(some), " ")
            source = pc.list_parent_indices(lists)
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            pos = np.arange(len(source)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            columns = [rows.column(c).take(source) for c in stay]
            yield pa.table([*columns, pa.array(pos.astype(np.int32)), lists.flatten()], schema.names)

    return TokenRows(df.asTable())


def sessions(
    df: DataFrame, keys: list[str], time: str, value: str, gap: datetime.timedelta, ties: list[str] | None = None
) -> DataFrame:
    """``(keys, session, started, ended, n, total)``: runs of rows of a key in which each
    comes at most ``gap`` after the one before; numbered from 1 per key.

    A table function of a TABLE argument that is partitioned by key and ordered by time:
    batches of a key stream by in order, and a session is given out when it has ended, so
    none of a key's rows are held. Null values add nothing to ``total``; rows without a
    time are left out. A key goes through one task, as in a window; cut hot keys by a
    coarser key first.
    """
    ended = T.StructType.fromDDL("session long, n long, total double").fields
    times = [T.StructField(c, df.schema[time].dataType) for c in ("started", "ended")]
    schema = T.StructType([*[df.schema[k] for k in keys], ended[0], *times, *ended[1:]])
    micros = gap // datetime.timedelta(microseconds=1)

    @arrow_udtf(returnType=schema)
    class Sessions:
        def __init__(self):
            self.open, self.done = None, 0

        def closed(self, last: dict):
            self.done += 1
            columns = [*last["keys"], pa.array([self.done], pa.int64()), last["started"], last["ended"]]
            return [*columns, pa.array([last["n"]], pa.int64()), pa.array([last["total"]])]

        def eval(self, rows: pa.RecordBatch):
            at = rows.column(time).cast(pa.timestamp("us", rows.column(time).type.tz)).cast(pa.int64()).to_numpy()
            amount = pc.fill_null(pc.cast(rows.column(value), pa.float64()), 0.0).to_numpy(zero_copy_only=False)
            before = at[:1] if self.open is None else np.array([self.open["at"]])
            starts = np.flatnonzero(np.diff(np.r_[before, at]) > micros)
            if self.open is None:
                starts = np.r_[0, starts]
            bounds, made = [*starts.tolist(), len(at)], []

            def go_on(low: int, high: int):
                if high > low:
                    self.open["n"] += high - low
                    self.open["total"] += float(amount[low:high].sum())
                    self.open["ended"], self.open["at"] = rows.column(time).slice(high - 1, 1), at[high - 1]

            if self.open is not None:
                go_on(0, bounds[0])
            for low, high in zip(bounds, bounds[1:]):
                if self.open is not None:
                    made.append(self.closed(self.open))
                heads = [rows.column(k).slice(low, 1) for k in keys]
                self.open = {"keys": heads, "started": rows.column(time).slice(low, 1), "n": 0, "total": 0.0}
                go_on(low, high)
            if made:
                yield pa.table([pa.concat_arrays(c) for c in zip(*made)], schema.names)

        def terminate(self):
            if self.open is not None:
                yield pa.table(self.closed(self.open), schema.names)

    given = df.select(*dict.fromkeys([*keys, time, value, *(ties or [])])).filter(F.col(time).isNotNull())
    return Sessions(given.asTable().partitionBy(*keys).orderBy(time, *(ties or [])))


def register_python_functions(spark: SparkSession) -> None:
    spark.udf.register("py_length", py_length)
    spark.udf.register("py_upper", py_upper)
    spark.udtf.register("tokens", Tokens)
