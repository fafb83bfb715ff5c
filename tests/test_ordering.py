import random
from decimal import Context, Decimal

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.plans import explain
from weft.operators import ordering, sets

LETTERS = [(x,) for x in "GMHMKMR"]


@pytest.fixture
def letters(spark):
    return spark.createDataFrame(LETTERS, "v string")


def test_sorts(spark, letters):
    assert [r.v for r in ordering.sort_by(letters, "v").collect()] == sorted("GMHMKMR")
    pairs = spark.createDataFrame([("b", 1), ("a", 2), ("b", 0)], "k string, v int")
    assert [tuple(r) for r in ordering.sort_by(pairs, "k", ties=["v"]).collect()] == [
        ("a", 2), ("b", 0), ("b", 1),
    ]
    # A constant key sorts nothing, every row stays.
    assert ordering.sort_by(letters, F.lit(True)).count() == 7


def test_top_and_take_ordered(letters):
    assert [r.v for r in ordering.top(letters, 2, "v").collect()] == ["R", "M"]
    assert [r.v for r in ordering.take_ordered(letters, 3, "v").collect()] == ["G", "H", "K"]
    assert "TakeOrderedAndProject" in explain(ordering.top(letters, 2, "v"))
    assert letters.first().v == "G" and letters.head().v == "G"
    assert [r.v for r in letters.head(2)] == [r.v for r in letters.take(2)] == ["G", "M"]


def test_a_hot_key_is_sorted_by_several_tasks(spark):
    df = spark.range(20_000).select(F.lit("k").alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        laid = ordering.sorted_within_keys(df.repartition(4), ["k"], ["id"])
        sizes = laid.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 8
    assert max(r["count"] for r in sizes) < 2 * 20_000 / 8


@pytest.mark.parametrize("partitions", [1, 3, 8])
@pytest.mark.parametrize("keys", [[], ["k"], ["k", "j"]])
def test_range_path_equals_window(spark, keys, partitions):
    rng = random.Random(3)
    rows = [
        (rng.choice(["hot", "hot", "hot", "x", None]), rng.choice([1, None]), i, rng.randint(0, 9))
        for i in range(500)
    ]
    df = spark.createDataFrame(rows, "k string, j int, id int, w long").repartition(partitions)
    window = Window.partitionBy(*keys).orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    for kind in ("long", "decimal(10,2)", "double"):
        rows = df.withColumn("w", F.col("w").cast(kind))
        expected = rows.withColumn("start", F.coalesce(F.sum("w").over(window), F.lit(0)))
        found = ordering.running_totals(rows, keys, ["id"], "w")
        assert found.columns == expected.columns
        assert found.schema["start"].dataType == rows.select(F.sum("w")).schema[0].dataType
        assert {tuple(r) for r in found.collect()} == {tuple(r) for r in expected.collect()}
        assert found.count() == 500


@pytest.mark.parametrize("low,high", [(0, 0), (3, 9_999), (4_095, 4_096)])
def test_explode_range(spark, low, high):
    df = spark.createDataFrame([("x", low, high)], "k string, a long, b long")
    found = ordering.explode_range(df, F.col("a"), F.col("b"), "i")
    assert [r.i for r in found.orderBy("i").collect()] == list(range(low, high + 1))
    assert found.columns == ["k", "a", "b", "i"]


def test_running_totals_go_on_over_batches_and_ranges(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.range(2_000).select((F.col("id") > 1_700).alias("k"), (F.col("id") % 3).alias("o"))
        found = ordering.running_totals(df.withColumn("w", F.lit(1)), ["k"], ["o"], "w")
        starts = {k: sorted(r.start for r in found.filter(F.col("k") == k).collect()) for k in (True, False)}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert starts == {True: list(range(299)), False: list(range(1_701))}
    wide = spark.range(9).select(F.lit(2**62).alias("w"), "id")
    with pytest.raises(Exception, match="range of long"):
        ordering.running_totals(wide, [], ["id"], "w").collect()


@pytest.mark.parametrize("kind", ["double", "small", "large"])
def test_sums_of_a_batch_equal_a_plain_loop(kind):
    """Runs of all lengths, some going on from the batch before; doubles to the last bit."""
    rng = random.Random(5)
    types = {"double": pa.float64(), "small": pa.decimal128(22, 2), "large": pa.decimal128(38, 0)}
    make = {
        "double": lambda: rng.choice([0.1, -0.0, 1e17, -3.3, float("inf"), 2.5e-9]) if rng.random() < 0.1 else rng.random(),
        "small": lambda: Decimal(rng.randint(-(10**12), 10**12)).scaleb(-2),
        "large": lambda: Decimal(rng.randint(10**30, 10**31)),
    }[kind]
    context = Context(prec=76)
    for trial in range(60):
        values = [make() for _ in range(rng.randint(1, 400))]
        starts = [i for i in range(len(values)) if rng.random() < rng.choice([0.01, 0.5])]
        held = pa.scalar(make(), types[kind]) if trial % 2 else None
        if held is None and 0 not in starts:
            starts = [0, *starts]
        batch = pa.array([make(), *values], types[kind])[1:]
        end, before = ordering._sums(batch, np.array(starts, np.int64), held)
        total, want = (held.as_py() if held is not None else None), []
        for i, value in enumerate(batch.to_pylist()):
            total = type(value)(0) if i in starts else total
            add = total + value if kind == "double" else context.add(total, value)
            want.append((total, add))
            total = add
        assert before.type == end.type == types[kind]
        assert [(repr(a), repr(b)) for a, b in zip(before.to_pylist(), end.to_pylist())] == [
            (repr(a), repr(b)) for a, b in zip(*(pa.array(c, types[kind]).to_pylist() for c in zip(*want)))
        ]


def test_running_totals_of_large_decimals(spark):
    """Beyond 28 digits too every digit counts; too many digits are an error."""
    rows = spark.range(40).select("id", F.expr("cast('1000000000000000000000000000000000001' as decimal(38,0)) as w"))
    found = ordering.running_totals(rows, [], ["id"], "w").orderBy("id").collect()
    assert [int(r["start"]) for r in found] == [i * (10**36 + 1) for i in range(40)]
    wide = rows.withColumn("w", F.expr("cast(repeat('9', 38) as decimal(38,0))"))
    with pytest.raises(Exception):
        ordering.running_totals(wide, [], ["id"], "w").collect()


def test_running_totals_exchange_rows_once(spark):
    from weft.sources import scratch

    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_custkey", "o_orderkey")
    plans = []
    plain = scratch.stored
    try:
        ordering.stored = lambda frame, label: plans.append(explain(frame)) or plain(frame, label)
        placed = ordering.running_totals(df, ["o_custkey"], ["o_orderkey"], "o_orderkey")
    finally:
        ordering.stored = plain
    assert plans[0].split("\n\n\n")[0].count("Exchange") == 1
    assert "SortMergeJoin" not in explain(placed)


def test_quantiles_of_many_columns(spark):
    folder = "/root/testdata/sf0.001/lineitem.parquet"
    df = spark.read.parquet(folder)
    columns = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"]
    table = ordering.quantile_table(df, columns, {"q1": 0.25, "q9": 0.9})
    assert table.count() == 5
    for r in table.collect():
        values = sorted(x[0] for x in df.select(r.field).collect())
        for share, struct in ((0.25, r.q1), (0.9, r.q9)):
            found = [v for v in struct if v is not None]
            assert found == [values[max(1, ordering._ceil_share(len(values), share)) - 1]]


def test_quantiles_take_two_scans_and_settle_nan_and_missed_brackets(spark, monkeypatch):
    scans, plain = [], ordering.stored
    monkeypatch.setattr(ordering, "stored", lambda df, label: scans.append(label) or plain(df, label))
    rng = random.Random(8)
    values = [rng.gauss(0, 1) for _ in range(20_000)] + [float("nan")] * 300 + [None] * 50
    rows = [(v, rng.randint(-(2**62), 2**62), None if v is None else rng.randint(-300, 300)) for v in values]
    df = spark.createDataFrame(rows, "v double, i long, s short").repartition(5)
    df = df.withColumns({"f": F.col("v").cast("float"), "d": F.col("s").cast("decimal(20,2)"), "none": F.lit(None).cast("int")})
    df = plain(df, "given")
    shares = {"q0": 0.0, "q3": 0.3, "q99": 0.99, "q1": 1.0}
    columns = ["v", "i", "s", "f", "d", "none"]
    found = {r["field"]: r for r in ordering.quantile_table(df, columns, shares).collect()}
    assert scans.count("inside") == 1
    for c in columns:
        present = sorted((r[0] for r in df.select(c).collect() if r[0] is not None), key=lambda x: (x != x, x))
        for q, share in shares.items():
            got = [x for x in found[c][q] or [] if x is not None] if found[c][q] else []
            want = [present[max(1, ordering._ceil_share(len(present), share)) - 1]] if present else []
            assert str(got) == str(want)
    # Sketches of another table: every bracket misses, and the quantiles are right all the same.
    other = ordering.quantile_sketches(df.select((F.col("i") * 0 + 5).alias("i")), ["i"])
    settled = ordering.quantile_table(df.select("i"), ["i"], {"q": 0.5}, sketches=other).first()
    assert settled["q"]["v0"] == sorted(r[0] for r in df.select("i").collect())[20_350 // 2 - 1]


def test_sketches_of_parts_are_merged(spark):
    df = spark.range(30_000).select("id", (F.col("id") * 0.5).alias("x"))
    parts = [ordering.quantile_sketches(df.filter(F.col("id") % 3 == i), ["id", "x"]) for i in range(3)]
    empty = ordering.quantile_sketches(df.filter("id < 0"), ["id", "x"])
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(empty)
    assert {r["field"]: r["n"] for r in ordering.merged_sketches(whole).collect()} == {"id": 30_000, "x": 30_000}
    table = ordering.quantile_table(df, ["id", "x"], {"q": 0.1}, sketches=whole)
    assert {r["field"]: [v for v in r["q"] if v is not None] for r in table.collect()} == {"id": [2999], "x": [1499.5]}


def test_quantiles(spark):
    values = [5] * 60 + list(range(40)) + [None] * 9
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(4)
    shares = {"lo": 0.0, "q1": 0.25, "q2": 0.5, "q3": 0.75, "hi": 1.0}
    found = ordering.quantiles(df, "v", shares).first()
    present = sorted(v for v in values if v is not None)
    expected = [present[0], present[24], present[49], present[74], present[-1]]
    assert list(found) == expected
    empty = ordering.quantiles(df.filter("v > 99"), "v", {"q": 0.5}).first()
    assert empty.q is None


def test_sets(spark):
    left = spark.createDataFrame([("P",), ("Q",), ("R",), ("Q",), (None,)], "v string")
    right = spark.createDataFrame([("P",), ("S",), ("P",), ("P",), (None,)], "w string")
    assert {r.v for r in sets.intersection(left, right).collect()} == {"P", None}
    assert sets.intersection(left, right).count() == left.intersect(right).count() == 2
    assert sets.union_all(left, right, left).count() == 15
    assert sets.distinct(left).count() == 4
    assert sets.distinct(left, "v").columns == ["v"]
    assert explain(sets.intersection(left, right)).split("\n\n\n")[0].count("Exchange") == 1


def test_results_can_be_streamed_to_the_driver(spark):
    assert [r.id for r in spark.range(5).orderBy("id").toLocalIterator()] == [0, 1, 2, 3, 4]


def test_cache_is_used_by_later_plans(spark):
    df = spark.range(100).selectExpr("id % 7 AS v").cache()
    try:
        assert df.count() == 100
        assert "InMemoryTableScan" in explain(df.groupBy("v").count())
    finally:
        df.unpersist()
