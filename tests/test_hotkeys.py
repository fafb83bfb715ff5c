"""Summaries of frequent keys, and helper columns that clash with no name."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.plans import exchanges, explain, tree
from weft.operators import grouping, joins, ordering
from weft.operators.hotkeys import frequent_keys, heavy_hitters
from weft.operators.typed_aggregate import aggregate_with, average
from weft.sources import scratch

TAKEN = ["_w", "_tie", "_m1", "_m2", "_range", "_at", "_whole", "_before", "_end", "_base", "_one", "_laid", "_v", "_cost"]


def zipf(n, seed=1):
    rng = random.Random(seed)
    keys = [None, *range(1, 2000)]
    return rng.choices(keys, [1 / (i + 1) for i in range(2000)], k=n)


@pytest.mark.parametrize("counters", [10, 200, 5000])
def test_a_summary_holds_every_frequent_key(spark, counters):
    keys = zipf(20_000)
    df = spark.createDataFrame([(k,) for k in keys], "k int").repartition(6)
    summary = scratch.stored(heavy_hitters(df, ["k"], counters=counters), "test")
    total, missed = summary.agg(F.sum("_rows"), F.sum("_missed")).first()
    assert total == 20_000 and missed <= 2 * 20_000 / counters
    # The summaries of six tasks are no larger than their counters.
    assert summary.filter("_n IS NOT NULL").count() <= 6 * counters
    found = {r["_k0"]: r["n"] for r in summary.filter("_n IS NOT NULL").groupBy("_k0").agg(F.sum("_n").alias("n")).collect()}
    for key, n in Counter(keys).items():
        assert found.get(key, 0) <= n <= found.get(key, 0) + missed
    hot, bound, rows = frequent_keys(summary, ["_k0"], 8, 300)
    hot = {r["_k0"]: r["_n"] for r in hot.collect()}
    counts = Counter(keys)
    assert rows == 20_000 and {k for k, n in counts.items() if n > bound} <= set(hot)
    assert all(n >= counts[k] > bound // 2 for k, n in hot.items())


def test_distinct_keys_leave_nothing_behind(spark):
    df = spark.range(50_000).repartition(4)
    for options in ({"counters": 100}, {"ignored": 1}):
        kept = heavy_hitters(df, ["id"], **options).collect()
        assert len(kept) == 4 and sum(r["_rows"] for r in kept) == 50_000
    assert heavy_hitters(df.filter("id < 0"), ["id"]).count() == 0


def test_outer_joins_exchange_no_key_counts(spark, monkeypatch):
    plans, plain = [], joins.stored
    monkeypatch.setattr(joins, "stored", lambda df, label: plans.append(explain(df)) or plain(df, label))
    left = spark.range(1000).withColumn("l", F.lit(1))
    right = spark.range(500, 1500).withColumn("r", F.lit(1))
    assert joins.equi_join(left, right, ["id"], "full").count() == 1500
    assert len(plans) == 1 and "Exchange" not in plans[0]


def test_group_chunks_exchange_rows_once_and_keep_no_copy(spark, monkeypatch):
    labels, plain = [], grouping.stored
    monkeypatch.setattr(grouping, "stored", lambda df, label: labels.append((label, df.columns)) or plain(df, label))
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    chunks = grouping.group_chunks(df, ["o_custkey"], "o_orderkey")
    assert exchanges(chunks) == 1 and "Window" not in tree(chunks)
    assert labels == [("frequent-keys", ["_k0", "_k1", "_m1", "_m2", "_n", "_rows", "_missed"])]


@pytest.mark.parametrize("batch", [3, 10_000])
def test_hot_and_other_keys_have_the_same_chunks(spark, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        rows = [(k, i * 7919 % 1000, "x" * (i % 90)) for i, k in enumerate(zipf(3000, 2))]
        df = spark.createDataFrame(rows, "k int, v int, t string").repartition(5)
        for value in ("v", "t"):
            ways = [
                sorted(grouping.group_chunks(df, ["k"], value, chunk_rows=7, chunk_bytes=300, hot_rows=hot).collect(), key=repr)
                for hot in (None, 10, 1_000_000)
            ]
            assert ways[0] == ways[1] == ways[2]
            assert sum(len(r["values"]) for r in ways[0]) == 3000
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_positions_take_no_exchange(spark, monkeypatch):
    plans, plain = [], ordering.stored
    monkeypatch.setattr(ordering, "stored", lambda df, label: plans.append(explain(df)) or plain(df, label))
    df = spark.range(1000, numPartitions=5).withColumn("k", F.col("id") > 480)
    found = ordering.with_position(df)
    assert {(r["id"], r["position"]) for r in found.collect()} == {(i, i) for i in range(1000)}
    found = ordering.with_position(df, ["k"], gathered=True)
    assert {(r["id"], r["position"]) for r in found.collect()} == {(i, i - 481 * (i > 480)) for i in range(1000)}
    assert len(plans) == 2 and not any("Exchange" in p for p in plans)
    assert exchanges(ordering.with_position(df)) <= 3  # sizes of partitions only
    assert ordering.with_position(df.filter("id < 0")).count() == 0


def test_gathered_positions_equal_those_of_any_layout(spark):
    rows = [(k, i) for i, k in enumerate(zipf(2000, 5))]
    df = spark.createDataFrame(rows, "k int, v int").repartition(4)
    laid = scratch.stored(ordering.sorted_within_keys(df, ["k"], ["v"]), "laid")
    ways = [
        {tuple(r) for r in ordering.with_position(laid.orderBy("k", "v"), ["k"], gathered=g).collect()} for g in (True, False)
    ]
    seen, want = Counter(), set()
    for k, v in sorted(rows, key=lambda r: (r[0] is not None, r)):
        want.add((k, v, seen[k]))
        seen[k] += 1
    assert ways[0] == ways[1] == want


def test_any_column_name_is_kept(spark):
    df = spark.range(60).select(*[(F.col("id") % (i + 2)).alias(c) for i, c in enumerate(TAKEN)], "id")
    placed = ordering.running_totals(df, ["_m1"], ["id"], "_w")
    assert placed.columns == [*df.columns, "start"] and placed.count() == 60
    for numbered in (ordering.with_position(df), ordering.with_position(df, ["_v"])):
        assert numbered.columns == [*df.columns, "position"]
        assert numbered.select("_one", "_laid").distinct().count() > 20
    for hot in (1, None):
        groups = grouping.group_chunks(df, ["_v", "_m1"], "_cost", hot_rows=hot)
        assert groups.columns == ["_v", "_m1", "chunk", "values"] and sum(len(r["values"]) for r in groups.collect()) == 60
    averages = aggregate_with(df, ["_m1", "_m2"], "_w", average())
    assert averages.columns == ["_m1", "_m2", "result"] and averages.count() == df.select("_m1", "_m2").distinct().count()
    left = spark.range(90).select((F.col("id") % 3).alias("_k0"), F.lit(1).alias("_l"), F.col("id").alias("_copied_left"))
    right = spark.range(9).select((F.col("id") % 4).alias("_k0"), F.lit(2).alias("_r"), F.col("id").alias("a1"))
    for how in ("left", "right", "full"):
        found = joins.equi_join(left, right, ["_k0"], how, hot_rows=1)
        plain = left.join(right, ["_k0"], how)
        assert found.columns == plain.columns and found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty()
    spread_out = ordering.explode_range(df.select("_w", F.lit(7).alias("_low")), F.lit(1), F.lit(3), "_block")
    assert spread_out.columns == ["_w", "_low", "_block"] and spread_out.count() == 180


def map_rows():
    rows = []
    for i in range(40):
        entries = [("a", i % 2), ("b", i % 3)]
        rows.append((dict(entries if i % 4 else entries[::-1]), i))
    return [*rows, ({}, 1), ({}, 3), (None, 5), ({"a": None}, 7)]


@pytest.mark.parametrize("shape", ["map", "struct", "array"])
def test_map_keys_are_equal_whatever_the_order_of_entries(spark, shape):
    df = spark.createDataFrame(map_rows(), "m map<string,int>, v long").repartition(3)
    key = {"map": F.col("m"), "struct": F.struct("m", F.lit(1).alias("x")), "array": F.array("m", "m")}[shape]
    df = df.select(key.alias("k"), "m", "v")
    plain = lambda m: None if m is None else tuple(sorted(m.items()))
    want = {}
    for m, v in map_rows():
        want.setdefault(plain(m), []).append(v)
    inner = {"map": lambda k: k, "struct": lambda k: k["m"], "array": lambda k: k[0]}[shape]
    found = aggregate_with(df, ["k"], "v", average()).collect()
    assert {plain(inner(r["k"])): r["result"] for r in found} == {k: sum(v) / len(v) for k, v in want.items()}
    assert len(found) == len(want)
    if shape == "map":
        chunks = grouping.group_chunks(df, ["k"], "v").collect()
        assert {plain(r["k"]): r["values"] for r in chunks} == {k: sorted(v) for k, v in want.items()}
