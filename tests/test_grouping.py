import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.plans import tree
from weft.functions import aggregates as own
from weft.operators.grouping import (
    aggregate,
    count_by_key,
    count_by_value,
    describe,
    group_chunks,
    group_rows_by,
    reduce_by_key,
    summary,
)

PEOPLE = [("Rosa", None), ("Imre", 41), ("Noor", 23), ("Olu", 41), ("Olu", 55)]
LETTERS = [(x,) for x in "GMHMKMR"]


@pytest.fixture
def people(spark):
    return spark.createDataFrame(PEOPLE, "name string, age long")


def test_counts(spark, people):
    assert {r.age: r.n for r in count_by_key(people, "age").collect()} == {
        None: 1, 41: 2, 23: 1, 55: 1,
    }
    letters = spark.createDataFrame(LETTERS, "v string")
    assert {r.v: r.n for r in count_by_value(letters).collect()} == {
        "G": 1, "M": 3, "H": 1, "K": 1, "R": 1,
    }
    pairs = spark.createDataFrame([("D", 4), ("E", 4), ("D", 4), ("F", 4)], "k string, v int")
    assert {(r.k, r.v): r.n for r in count_by_value(pairs).collect()} == {
        ("D", 4): 2, ("E", 4): 1, ("F", 4): 1,
    }


def test_max_min_avg_skip_nulls(people):
    rows = aggregate(
        people, ["name"], [("age", "max", "mx"), ("age", "avg", "av"), ("age", "min", "mn")]
    )
    assert rows.columns == ["name", "mx", "av", "mn"]
    found = {r.name: (r.mx, r.av, r.mn) for r in rows.collect()}
    assert found["Olu"] == (55, 48.0, 41)
    assert found["Rosa"] == (None, None, None)


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_reduce(spark, partitions):
    pairs = spark.createDataFrame([("D", 4), ("E", 4), ("D", 4), ("F", 4)], "k string, v long")
    pairs = pairs.repartition(partitions)
    found = {r.k: r.t for r in reduce_by_key(pairs, ["k"], "v", "sum", "t").collect()}
    assert found == {"D": 8, "E": 4, "F": 4}
    assert reduce_by_key(pairs, [], "v", "sum", "t").first().t == 16
    with pytest.raises(ValueError):
        reduce_by_key(pairs, ["k"], "v", "first", "t")
    assert tree(reduce_by_key(pairs, ["k"], "v", "sum", "t")).count("HashAggregate") == 2


def test_fold_takes_neutral_start_only(spark):
    df = spark.createDataFrame([(1,), (2,)], "v int")
    assert df.agg(own.fold("v").alias("t")).first().t == 3
    assert df.filter("v > 9").agg(own.fold("v").alias("t")).first().t == 0
    with pytest.raises(ValueError):
        own.fold("v", zero=5)
    with pytest.raises(ValueError):
        own.fold("v", how="max")


@pytest.mark.parametrize("slices", [1, 2, 3, 4, 5])
def test_fold_with_other_start_depends_on_partitions(spark, slices):
    # Why a start value that is not neutral is refused: it enters once per partition
    # and once more at the end.
    rdd = spark.sparkContext.parallelize(["x", "y", "z"], slices)
    found = rdd.fold("-", lambda a, b: a + b)
    assert found.replace("-", "") == "xyz"
    assert found.count("-") == slices + 1


def test_hand_written_aggregate_rules(spark):
    rows = [("neg", -5), ("neg", -2), ("none", None), ("pos", 3), ("pos", 4), ("pos", None)]
    df = spark.createDataFrame(rows, "k string, v long")
    found = {
        r.k: r
        for r in df.groupBy("k").agg(
            own.count_values("v").alias("n"),
            own.max_or_zero("v").alias("mx"),
            own.sum_or_zero("v").alias("t"),
            own.average_or_nan("v").alias("av"),
            own.whole_average("v").alias("whole"),
        ).collect()
    }
    assert (found["neg"].n, found["neg"].mx, found["neg"].t, found["neg"].whole) == (2, 0, -7, -3)
    assert (found["none"].n, found["none"].mx, found["none"].t, found["none"].whole) == (0, 0, 0, None)
    assert math.isnan(found["none"].av)
    assert (found["pos"].mx, found["pos"].t, found["pos"].av, found["pos"].whole) == (4, 7, 3.5, 3)
    empty = df.filter("k = 'x'").agg(own.sum_or_zero("v").alias("t"), own.max_or_zero("v").alias("m"))
    assert tuple(empty.first()) == (0, 0)


def test_aggregates_of_one_column(spark):
    df = spark.createDataFrame([("p", 120), ("q", 450), ("r", 270), ("s", 90)], "name string, pay long")
    row = df.agg(
        own.count_values("pay"), own.max_or_zero("pay"), own.sum_or_zero("pay"),
        own.average_or_nan("pay"), own.whole_average("pay"),
    ).first()
    assert tuple(row) == (4, 450, 930, 232.5, 232)


def chunks_by_key(df, key="k"):
    found = defaultdict(list)
    for row in df.orderBy("chunk").collect():
        assert len(found[row[key]]) == row.chunk
        found[row[key]].append(row["values"])
    return found


GROUPED = (
    [("hot", i % 37) for i in range(400)]
    + [("hot", 5)] * 300
    + [(None, 3), (None, None), (None, 1)]
    + [("one", 9), ("nulls", None), ("nulls", None)]
)


@pytest.mark.parametrize(
    "partitions,chunk_rows", [(1, 10_000), (8, 16), (3, 5), (1, 1)]
)
def test_group_chunks_hold_every_value_in_order(spark, partitions, chunk_rows):
    df = spark.createDataFrame(GROUPED, "k string, v int").repartition(partitions)
    found = chunks_by_key(group_chunks(df, ["k"], "v", chunk_rows=chunk_rows))
    expected = defaultdict(list)
    for k, v in GROUPED:
        expected[k].append(v)
    assert set(found) == set(expected)
    for k, values in expected.items():
        values.sort(key=lambda v: (v is not None, v))
        assert [v for chunk in found[k] for v in chunk] == values
        # Full chunks, but for the last.
        assert all(len(c) == chunk_rows for c in found[k][:-1])
        assert 0 < len(found[k][-1]) <= chunk_rows


@pytest.mark.parametrize(
    "kind,keys",
    [
        ("double", ["double('nan')", "0.0D", "-0.0D", "null"]),
        ("array<int>", ["array(1)", "array()", "null"]),
        ("struct<a:array<int>>", ["named_struct('a', array(1))", "named_struct('a', array(2))"]),
        ("timestamp_ntz", ["timestamp_ntz'+12000-01-01 00:00:00'", "null"]),
        ("decimal(20,2)", ["1.50", "2.00"]),
        ("string collate UTF8_LCASE", ["'x'", "'y'", "'z'", "null"]),
        ("array<string>", ["array('a', null)", "array('a')", "array(null)", "array()", "null"]),
        ("struct<a:string,b:string>", ["named_struct('a', 'x', 'b', null)", "named_struct('a', null, 'b', 'x')"]),
    ],
)
def test_group_chunks_for_key_types(spark, kind, keys):
    """Small chunks hold the same values as whole groups, and types stay."""
    cases = " ".join(f"WHEN {i} THEN CAST({k} AS {kind})" for i, k in enumerate(keys))
    rows = spark.range(25 * len(keys)).repartition(4)
    df = rows.selectExpr(f"CASE id % {len(keys)} {cases} END AS k", "id AS v")
    large = group_chunks(df, ["k"], "v", chunk_rows=10)
    assert large.schema["k"].dataType == df.schema["k"].dataType
    text = F.to_json(F.struct("k")).alias("t")
    found = defaultdict(list)
    for r in large.select(text, "chunk", "values").orderBy("chunk").collect():
        assert len(found[r.t]) == 10 * r.chunk and len(r["values"]) <= 10
        found[r.t] += r["values"]
    expected = defaultdict(list)
    for r in df.groupBy("k").agg(F.sort_array(F.collect_list("v")).alias("v")).select(text, "v").collect():
        expected[r.t] = r.v
    assert found == expected


def test_keys_that_are_equal_under_a_collation_are_one(spark):
    df = spark.range(40).repartition(3).selectExpr(
        "CAST(CASE WHEN id % 4 = 0 THEN 'k' WHEN id % 4 = 1 THEN 'K' ELSE 'l' END AS STRING COLLATE UTF8_LCASE) AS k",
        "id AS v",
    )
    found = group_chunks(df, ["k"], "v", chunk_rows=6).orderBy("chunk").collect()
    by_key = defaultdict(list)
    for r in found:
        by_key[r.k.lower()] += r["values"]
    assert by_key == {
        "k": [i for i in range(40) if i % 4 < 2], "l": [i for i in range(40) if i % 4 > 1],
    }


def test_group_chunks_keep_values_as_they_are(spark):
    df = spark.sql(
        "SELECT 'k' AS k, v, CAST(t AS STRING COLLATE UTF8_LCASE) AS t "
        "FROM VALUES (1.0D, 'a'), (-0.0D, 'A'), (0.0D, 'a'), (double('nan'), 'B') AS rows(v, t)"
    )
    values = group_chunks(df, ["k"], "v", chunk_rows=2).orderBy("chunk").collect()
    assert sorted(str(v) for r in values for v in r["values"]) == ["-0.0", "0.0", "1.0", "nan"]
    texts = group_chunks(df, ["k"], "t").first()["values"]
    assert Counter(texts) == Counter(["a", "A", "a", "B"]) and texts[3] == "B"


def test_group_chunks_are_bounded_in_bytes(spark):
    df = spark.range(40).select(F.lit("k").alias("k"), F.repeat(F.lit("x"), F.col("id").cast("int") * 10).alias("v"))
    chunks = group_chunks(df, ["k"], "v", chunk_rows=10, chunk_bytes=1000).orderBy("chunk").collect()
    assert [v for r in chunks for v in r["values"]] == ["x" * 10 * i for i in range(40)]
    assert max(sum(map(len, r["values"])) for r in chunks) <= 1400
    assert max(len(r["values"]) for r in chunks) <= 10


def test_group_chunks_of_values_of_many_kinds(spark):
    df = spark.range(30).select(
        F.lit("k").alias("k"),
        F.struct((F.col("id") % 7).alias("a"), F.array("id").alias("b")).alias("v"),
    )
    found = group_chunks(df, ["k"], "v", chunk_rows=8).orderBy("chunk").collect()
    values = [v for r in found for v in r["values"]]
    assert [len(r["values"]) for r in found] == [8, 8, 8, 6]
    assert values == sorted(values, key=lambda v: (v.a, v.b))


def test_group_chunks_of_nothing(spark):
    df = spark.createDataFrame([], "k string, v int")
    assert group_chunks(df, ["k"], "v").count() == 0


def test_group_rows_by_computed_key(spark):
    df = spark.createDataFrame([("D", 4), ("E", 4), ("D", 4), ("F", 4)], "k string, v int")
    found = chunks_by_key(group_rows_by(df, F.lower("k"), name="g"), "g")
    assert {g: [[tuple(r) for r in c] for c in chunks] for g, chunks in found.items()} == {
        "d": [[("D", 4), ("D", 4)]], "e": [[("E", 4)]], "f": [[("F", 4)]],
    }


def test_describe_matches_spark(people):
    found = {r.field: r for r in describe(people, ["age", "name"]).collect()}
    assert found["age"].n == 4 and found["age"]["mean"] == 40.0
    assert (found["age"].lowest, found["age"].highest) == ("23", "55")
    assert found["name"]["mean"] is None and found["name"].highest == "Rosa"
    built_in = {r["summary"]: r["age"] for r in people.describe("age").collect()}
    assert float(built_in["stddev"]) == found["age"].sd
    row = describe(people.filter("name IN ('Rosa', 'Imre', 'Noor')"), ["age"]).first()
    assert (row["mean"], row.sd) == (32.0, pytest.approx(162**0.5))


def test_summary_matches_spark(people):
    table = {r.field: r for r in summary(people, ["age", "name"]).collect()}
    built_in = {r["summary"]: r["age"] for r in people.summary().collect()}
    row = table["age"]
    assert (row.q25, row.q50, row.q75) == (built_in["25%"], built_in["50%"], built_in["75%"])
    assert table["name"].q50 is None and table["name"].n == 5
    rough = {r.field: r for r in summary(people, ["age", "name"], exact=False).collect()}
    assert (rough["age"].q25, rough["age"].q75) == (row.q25, row.q75) and rough["name"].q50 is None
    subset = people.summary("count", "max")
    assert [r["summary"] for r in subset.collect()] == ["count", "max"]
