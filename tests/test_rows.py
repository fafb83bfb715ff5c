from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.plans import explain
from weft.operators.rows import (
    enforce_schema,
    hash_sample,
    map_batches,
    preview,
    random_sample,
    schema_status,
)
from weft.sources.files import key_between
from weft.sources.schemas import record_schema

PEOPLE = [("Rosa", None), ("Imre", 41), ("Noor", 23), ("Olu", 41), ("Olu", 55)]


@pytest.fixture
def people(spark):
    return spark.createDataFrame(PEOPLE, "name string, age long")


def test_null_rules_of_projection_and_filter(people):
    plus = {r.name: r.b for r in people.select("name", (F.col("age") + 1).alias("b")).collect()}
    assert plus["Rosa"] is None and plus["Imre"] == 42
    assert people.filter("age > 30").count() == 3
    assert people.where(F.col("age") > 30).count() == 3
    assert people.filter(F.col("age").between(23, 41)).count() == 3
    assert people.na.drop().count() == 4
    assert people.withColumn("u", F.upper("name")).columns == ["name", "age", "u"]


def test_overflow_raises(spark):
    df = spark.createDataFrame([(2**63 - 1,)], "v long")
    with pytest.raises(Exception, match="ARITHMETIC_OVERFLOW"):
        df.select(F.col("v") + 1).collect()


def test_key_range_keeps_both_ends(spark):
    df = spark.createDataFrame([("f", 5), ("k", 9), ("g", 6), ("k", 4)], "k string, v int")
    found = df.filter(key_between("k", "f", "g")).collect()
    assert sorted(tuple(r) for r in found) == [("f", 5), ("g", 6)]


def test_filters_and_columns_reach_the_scan(spark):
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    text = explain(part.filter(F.col("p_size").between(13, 30)).select("p_name"))
    assert "GreaterThanOrEqual(p_size,13)" in text and "LessThanOrEqual(p_size,30)" in text
    assert "ReadSchema: struct<p_name:string,p_size:int>" in text
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    assert "StringStartsWith(event_type,s)" in explain(
        events.filter(F.col("event_type").startswith("s"))
    )


STRICT = T.StructType(
    [T.StructField("age", T.LongType(), False), T.StructField("name", T.StringType())]
)


def test_schema_guard_splits_rows(people):
    ok, rejected = enforce_schema(people, STRICT)
    assert ok.columns == ["age", "name"]
    assert ok.count() == 4
    assert [r.name for r in rejected.collect()] == ["Rosa"]


def test_schema_guard_widens_but_does_not_narrow(spark):
    ints = spark.createDataFrame([("a", 1)], "name string, age int")
    assert dict(schema_status(ints, STRICT).dtypes)["age"] == "bigint"
    texts = spark.createDataFrame([("a", "1")], "name string, age string")
    with pytest.raises(Exception, match="INVALID_COLUMN_OR_FIELD_DATA_TYPE"):
        schema_status(texts, STRICT)
    with pytest.raises(ValueError, match="age"):
        schema_status(spark.createDataFrame([("a",)], "name string"), STRICT)


@dataclass
class Person:
    name: str
    age: int


@dataclass
class Visit:
    who: Person
    score: float | None
    days: list[int]
    new: bool


def test_record_schema(spark, people):
    assert record_schema(Person) == T.StructType(
        [T.StructField("name", T.StringType()), T.StructField("age", T.LongType(), False)]
    )
    visit = record_schema(Visit)
    assert visit["who"].dataType == record_schema(Person)
    assert visit["score"].nullable and not visit["new"].nullable
    assert visit["days"].dataType == T.ArrayType(T.LongType())
    ok, rejected = enforce_schema(people, record_schema(Person))
    assert (ok.count(), rejected.count()) == (4, 1)
    rows = spark.createDataFrame([Person("Noor", 23)], record_schema(Person))
    assert rows.first() == ("Noor", 23)


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_map_batches(spark, partitions):
    def double(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pc.multiply(batch.column("id"), 2)], ["id"])

    df = spark.range(0, 100, 1, partitions)
    assert map_batches(df, double, "id long").agg(F.sum("id")).first()[0] == 9900
    assert map_batches(df.filter("id < 0"), double, "id long").count() == 0


def test_hash_sample_is_stable(spark):
    df = spark.range(20_000)
    first = {r.id for r in hash_sample(df.repartition(3), "id", 0.1).collect()}
    second = {r.id for r in hash_sample(df.repartition(7), "id", 0.1).collect()}
    assert first == second
    assert 1_700 < len(first) < 2_300
    assert hash_sample(df, "id", 1.0).count() == 20_000
    assert hash_sample(df, "id", 0.0).count() == 0
    holes = spark.createDataFrame([(None,), (1,), (None,)], "id long")
    assert hash_sample(holes, "id", 1.0).count() == 3


def test_random_sample_has_no_copies(spark):
    found = [r.id for r in random_sample(spark.range(20_000), 0.1, 7).collect()]
    assert len(found) == len(set(found))
    assert 1_700 < len(found) < 2_300


def test_preview(spark):
    df = spark.createDataFrame([(2, "b" * 30), (1, "a")], "id int, s string")
    flat = [tuple(r) for r in preview(df, 2, order=["id"]).collect()]
    assert flat == [("1", "a"), ("2", "b" * 17 + "...")]
    assert preview(df, 1, order=["id"]).count() == 1
    assert preview(df, 5).count() == 2
    tall = [tuple(r) for r in preview(df, 2, order=["id"], width=None, vertical=True).collect()]
    assert sorted(tall) == [
        (1, "id", "1"), (1, "s", "a"), (2, "id", "2"), (2, "s", "b" * 30),
    ]


def test_side_effects_per_partition(spark):
    seen = spark.sparkContext.accumulator(0)

    def visit(rows):
        seen.add(sum(1 for _ in rows))

    spark.range(0, 50, 1, 4).foreachPartition(visit)
    assert seen.value == 50
    spark.range(0, 50, 1, 4).foreach(lambda row: seen.add(1))
    assert seen.value == 100
