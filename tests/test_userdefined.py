import math

import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from tests.plans import explain
from weft.functions.text import words
from weft.functions.registered import register_python_functions, register_sql_functions
from weft.operators.typed_aggregate import Aggregator, aggregate_with, average


def largest_text():
    """A buffer with a null start, over strings."""

    def reduce(buffer, values):
        found = [v for v in (buffer[0], pc.max(values).as_py()) if v is not None]
        return (max(found, default=None), buffer[1] + len(values))

    def merge(a, b):
        found = [v for v in (a[0], b[0]) if v is not None]
        return (max(found, default=None), a[1] + b[1])

    return Aggregator(
        buffer="top string, n long",
        result="struct<top:string,n:long>",
        zero=lambda: (None, 0),
        reduce=reduce,
        merge=merge,
        finish=lambda b: {"top": b[0], "n": b[1]},
    )


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_average_per_key(spark, partitions):
    rows = [("a", 1), ("a", 2), ("b", None), (None, 4), (None, 6), ("c", -3)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(partitions)
    found = {r.k: r.result for r in aggregate_with(df, ["k"], "v", average()).collect()}
    assert math.isnan(found.pop("b"))
    assert found == {"a": 1.5, None: 5.0, "c": -3.0}


def test_average_of_the_whole_frame(spark):
    df = spark.createDataFrame(
        [("Rosa", 120), ("Imre", 450), ("Noor", 270), ("Pavel", 90)],
        "name string, salary long",
    )
    assert aggregate_with(df, [], "salary", average(), name="avg").first().avg == 232.5
    for empty in (df.filter("salary < 0"), spark.createDataFrame([], df.schema)):
        rows = aggregate_with(empty, [], "salary", average()).collect()
        assert len(rows) == 1 and math.isnan(rows[0].result)
        assert aggregate_with(empty, ["name"], "salary", average()).collect() == []


def test_several_keys_and_text_buffers(spark):
    rows = [(1, "x", "b"), (1, "x", "a"), (1, None, "c"), (2, None, None), (2, None, "z")]
    df = spark.createDataFrame(rows, "i int, k string, v string").repartition(3)
    rows = aggregate_with(df, ["i", "k"], "v", largest_text()).collect()
    found = {(r.i, r.k): tuple(r.result) for r in rows}
    assert found == {(1, "x"): ("b", 2), (1, None): ("c", 1), (2, None): ("z", 2)}


def test_keys_of_other_types(spark):
    df = spark.sql(
        "SELECT d > 1 AS t, CAST('2024-01-0' || d AS DATE) AS day, "
        "CAST(d AS DECIMAL(10,2)) AS dec, CAST('2024-01-0' || d AS TIMESTAMP_NTZ) AS at, d AS v "
        "FROM VALUES (1L), (2L), (2L) AS rows(d)"
    )
    keys = ["t", "day", "dec", "at"]
    found = aggregate_with(df, keys, "v", average(), name="a")
    assert found.dtypes == [*df.select(keys).dtypes, ("a", "double")]
    expected = df.groupBy(keys).agg(F.avg("v").alias("a"))
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in expected.collect()}


def test_nan_keys_and_many_keys(spark):
    nan = float("nan")
    df = spark.createDataFrame([(nan, 1), (nan, 3), (1.0, 5)], "k double, v long").repartition(3)
    found = [r.result for r in aggregate_with(df, ["k"], "v", average()).collect()]
    assert sorted(found) == [2.0, 5.0]
    zeros = spark.createDataFrame([(0.0, 1), (-0.0, 3)], "k double, v long").repartition(2)
    assert [r.result for r in aggregate_with(zeros, ["k"], "v", average()).collect()] == [2.0]
    many = spark.range(120_000).select((F.col("id") % 110_000).alias("k"), F.lit(2).alias("v"))
    out = aggregate_with(many.repartition(1), ["k"], "v", average())
    assert out.agg(F.count("k"), F.countDistinct("k"), F.max("result")).first()[:] == (
        110_000, 110_000, 2.0,
    )


def test_combine_runs_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    plan = explain(aggregate_with(df, ["k"], "v", average())).split("\n\n\n")[0]
    assert plan.count("MapInArrow") == 2 and plan.count("Exchange") == 1
    first, last = plan.find("MapInArrow"), plan.rfind("MapInArrow")
    assert first < plan.find("Exchange") < last


def test_registered_functions(spark):
    register_sql_functions(spark)
    register_python_functions(spark)
    df = spark.createDataFrame([("abc",), ("中文",), ("",), (None,), ("straße ﬁn",), ("ŉ ǰ  x  ",), ("   ",)], "s string")
    df.createOrReplaceTempView("texts")
    sql = spark.sql("SELECT s, str_length(s) AS n, str_upper(s) AS u FROM texts")
    python = spark.sql("SELECT s, py_length(s) AS n, py_upper(s) AS u FROM texts")
    assert {tuple(r) for r in sql.collect()} == {tuple(r) for r in python.collect()}
    assert "EvalPython" not in explain(sql)
    assert "ArrowEvalPython" in explain(python) and "BatchEvalPython" not in explain(python)
    tokens = spark.sql("SELECT s, pos, word FROM texts, LATERAL tokens(s)")
    pieces = df.select("s", F.posexplode(words("s")).alias("pos", "word"))
    assert {tuple(r) for r in tokens.collect()} == {tuple(r) for r in pieces.collect()}
    assert "BatchEval" not in explain(tokens)


def test_average_of_longs_cannot_wrap(spark):
    df = spark.range(3).select(F.lit(1).alias("k"), F.lit(2**62).alias("v"))
    for keys in ([], ["k"]):
        assert aggregate_with(df, keys, "v", average()).first().result == 2.0**62


@pytest.mark.parametrize(
    "kind,keys",
    [
        ("array<int>", ["array(1, 2)", "array()", "null"]),
        ("struct<a:array<string>>", ["named_struct('a', array('x'))", "null"]),
        ("timestamp", ["timestamp'+12000-01-01 00:00:00'", "timestamp'2024-01-01 00:00:00'"]),
        ("bigint", ["7", "8"]),
    ],
)
@pytest.mark.parametrize("make", [average, largest_text])
def test_keys_of_any_type(spark, kind, keys, make):
    cases = " ".join(f"WHEN {i} THEN CAST({k} AS {kind})" for i, k in enumerate(keys))
    df = spark.range(60).repartition(3).selectExpr(f"CASE id % {len(keys)} {cases} END AS k", "id AS v")
    if make is largest_text:
        df = df.withColumn("v", F.col("v").cast("string"))
    found = aggregate_with(df, ["k"], "v", make())
    text = F.to_json(F.struct("k"))
    if make is average:
        expected = df.groupBy("k").agg(F.avg("v").alias("result"))
    else:
        both = F.struct(F.max("v").alias("top"), F.count("v").alias("n"))
        expected = df.groupBy("k").agg(both.alias("result"))
    assert {tuple(r) for r in found.select(text, "result").collect()} == {
        tuple(r) for r in expected.select(text, "result").collect()
    }


def test_value_can_be_a_key(spark):
    df = spark.createDataFrame([(1,), (1,), (3,)], "k long")
    assert {tuple(r) for r in aggregate_with(df, ["k"], "k", average()).collect()} == {(1, 1.0), (3, 3.0)}
