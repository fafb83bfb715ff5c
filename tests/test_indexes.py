"""Look-ups that read little, merges that sort nothing, and schema manifests."""

import re

import pytest
from pyspark.sql import functions as F

from tests.plans import tree
from weft.sources.catalog import merge_buckets, save_bucketed, scratch_tables
from weft.sources.files import look_up, merged_schema_read, write_indexed, write_keyed
from weft.sources.scratch import scratch_path

ORDERS = "/root/testdata/sf0.01/orders.parquet"


def rows_scanned(df):
    """Rows that the scans of a plan gave, by its metrics after a run of it."""
    df.collect()
    found, open_ = 0, [df._jdf.queryExecution().executedPlan()]
    while open_:
        node = open_.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            node = node.executedPlan()
        children = node.children()
        open_ += [children.apply(i) for i in range(children.size())]
        if node.nodeName().startswith("Scan"):
            found += node.metrics().apply("numOutputRows").value()
    return found


def test_an_orc_look_up_reads_a_small_part_of_the_rows(spark):
    orders = spark.read.parquet(ORDERS)
    path = scratch_path(spark, "indexed")
    laid = orders.repartitionByRange(4, "o_custkey").sortWithinPartitions("o_custkey")
    write_indexed(laid, path, "o_orderkey", stride=1000)
    stored = spark.read.orc(path)
    total = orders.count()
    keys = orders.filter("o_orderkey % 5000 = 7").select("o_orderkey")
    found = look_up(stored, "o_orderkey", keys)
    assert sorted(r[0] for r in found.collect()) == sorted(r[0] for r in keys.collect())
    assert 0 < rows_scanned(found) <= 0.4 * total
    # No key lies outside the smallest and largest of a run, so it is the filters that help.
    plain = scratch_path(spark, "plain")
    laid.write.option("orc.row.index.stride", 1000).orc(plain)
    assert rows_scanned(look_up(spark.read.orc(plain), "o_orderkey", keys)) > 0.9 * total


def test_many_keys_are_joined_and_nulls_are_none(spark):
    stored = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    wanted = spark.createDataFrame([(2,), (2,), (None,), (9,)], "w long")
    for most in (1, 10):
        assert [tuple(r) for r in look_up(stored, "k", wanted, column="w", most=most).collect()] == [(2, "b")]
    assert look_up(stored, "k", wanted.filter("w IS NULL"), column="w").collect() == []


def test_a_look_up_reads_one_bucket(spark):
    with scratch_tables(spark) as tables:
        saved = save_bucketed(spark.read.parquet(ORDERS), tables.name("orders"), ["o_custkey"], 16)
        key = saved.first()["o_custkey"]
        found = look_up(saved, "o_custkey", spark.createDataFrame([(key,)], "o_custkey long"))
        file = F.col("_metadata.file_name")
        of_key = saved.filter(F.col("o_custkey") == key).select(file.alias("file")).distinct()
        bucket = saved.withColumn("file", file).join(of_key, "file")
        assert of_key.count() == 1 and found.count() > 0
        # All rows of that bucket's file are read, and no others.
        assert rows_scanned(found) == bucket.count() < saved.count() / 8


@pytest.mark.parametrize("how", ["inner", "left", "full"])
def test_sorted_buckets_are_merged_without_exchange_or_sort(spark, how):
    left = spark.range(3000).select((F.col("id") % 900).alias("k"), F.col("id").alias("a"))
    right = spark.range(2000).select((F.col("id") % 1100).alias("k"), F.col("id").alias("b"))
    with scratch_tables(spark) as tables:
        names = [tables.name("left"), tables.name("right")]
        for rows, name in zip((left, right), names):
            save_bucketed(rows, name, ["k"], 8)
        found = merge_buckets(spark, *names, ["k"], how)
        plan = tree(found)
        assert "SortMergeJoin" in plan and not re.search(r"[\s-](Sort|Exchange)\b", plan)
        plain = left.join(right, ["k"], how).collect()
        assert sorted(found.collect(), key=repr) == sorted(plain, key=repr)


def test_a_manifest_takes_up_new_directories_and_widens(spark, monkeypatch):
    root = scratch_path(spark, "manifest")
    write_keyed({1: spark.createDataFrame([(1, "x")], "a int, b string")}, root)
    write_keyed({2: spark.createDataFrame([(2, [1])], "a int, c array<int>")}, root)
    first = merged_schema_read(spark, root)
    assert first.dtypes == [("a", "int"), ("b", "string"), ("c", "array<int>"), ("key", "int")]
    # A later read opens no file for its schema.
    opened, plain = [], type(spark.read).parquet
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, *p, **o: opened.append(p[0]) or plain(self, *p, **o))
    again = merged_schema_read(spark, root)
    assert opened == [root, root] and sorted(again.collect()) == sorted(first.collect())
    write_keyed({3: spark.createDataFrame([(2**40, [2**41], 0.5)], "a long, c array<long>, d double")}, root)
    opened.clear()
    wide = merged_schema_read(spark, root)
    assert opened == [root, f"{root}/key=3", root]
    assert wide.dtypes == [("a", "bigint"), ("b", "string"), ("c", "array<bigint>"), ("d", "double"), ("key", "int")]
    assert sorted(tuple(r) for r in wide.select("key", "a", "d").collect()) == [(1, 1, None), (2, 2, None), (3, 2**40, 0.5)]
    assert wide.filter("key = 3").first()["c"] == [2**41] and wide.filter("key = 2").first()["c"] == [1]
    opened.clear()
    merged_schema_read(spark, root)
    assert opened == [root, root]
    write_keyed({4: spark.createDataFrame([("text",)], "a string")}, root)
    with pytest.raises(ValueError, match="column a is bigint here and string there"):
        merged_schema_read(spark, root)
