"""Projections, predicates, scalar functions and sampling."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weft.functions.text import json_object, labelled, parse_delimited
from weft.operators.rows import hash_sample, map_batches, schema_status
from weft.plans.registry import labelled_documents, query
from weft.sources.files import key_between


@query("P01", "SELECT c_name, c_acctbal FROM customer")
def select_columns(t):
    return t.customer.select("c_name", "c_acctbal")


@query("P02 P03 X07", "SELECT p_name, p_size + 1 AS p_size_1, p_size * p_size AS sq FROM part")
def select_arithmetic(t):
    return t.part.select("p_name", (F.col("p_size") + 1).alias("p_size_1"), "p_size").selectExpr(
        "p_name", "p_size_1", "p_size * p_size AS sq"
    )


@query(
    "P02",
    "SELECT doc_id, quality + 1 AS q1 FROM documents LEFT JOIN labels USING (doc_id)",
)
def null_arithmetic(t):
    return labelled_documents(t).select("doc_id", (F.col("quality") + 1).alias("q1"))


@query("P04", "SELECT p_name, p_size, p_size AS p_size_2 FROM part")
def duplicate_alias(t):
    return t.part.selectExpr("p_name", "p_size", "p_size AS p_size_2")


@query("P05", "SELECT * FROM part WHERE p_size > 20")
def filter_gt(t):
    return t.part.filter(F.col("p_size") > 20)


@query("P05", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_discount > 0.05")
def filter_sql_text(t):
    return t.lineitem.where("l_discount > 0.05D").select("l_orderkey", "l_linenumber")


@query("P07", "SELECT p_name, p_size FROM part WHERE p_size BETWEEN 13 AND 30")
def filter_between(t):
    return t.part.filter(F.col("p_size").between(13, 30)).select("p_name", "p_size")


@query("P08", "SELECT * FROM events WHERE starts_with(event_type, 's')")
def filter_prefix(t):
    return t.events.filter(F.col("event_type").startswith("s"))


@query(
    "P09",
    "SELECT * FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' "
    "AND TIMESTAMP '1997-06-30'",
)
def key_range_filter(t):
    low, high = (F.lit(d).cast("timestamp_ntz") for d in ("1996-01-01", "1997-06-30"))
    return t.orders.filter(key_between("o_orderdate", low, high))


@query(
    "P10",
    "SELECT doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id) "
    "WHERE quality IS NOT NULL AND toxic IS NOT NULL",
)
def drop_nulls(t):
    return labelled_documents(t).na.drop(how="any").select("doc_id", "quality", "toxic")


@query(
    "P11 P12",
    "SELECT doc_id, CAST(quality AS BIGINT) AS quality, "
    "CASE WHEN quality IS NULL THEN 'rejected' ELSE 'ok' END AS status "
    "FROM documents LEFT JOIN labels USING (doc_id)",
)
def schema_guard(t):
    expected = T.StructType(
        [
            T.StructField("doc_id", T.LongType(), False),
            T.StructField("quality", T.LongType(), False),
        ]
    )
    return schema_status(labelled_documents(t), expected)


@query("T01 X01", "SELECT c_custkey, c_name || 'aa' AS v FROM customer")
def map_concat(t):
    return t.customer.select("c_custkey", F.concat("c_name", F.lit("aa")).alias("v"))


@query("T04", "SELECT p_partkey, p_size + 1 AS p_size FROM part")
def map_partitions(t):
    def plus_one(batch: pa.RecordBatch) -> pa.RecordBatch:
        size = pc.add(batch.column("p_size"), pa.scalar(1, pa.int32()))
        return pa.RecordBatch.from_arrays([batch.column("p_partkey"), size], ["p_partkey", "p_size"])

    return map_batches(t.part.select("p_partkey", "p_size"), plus_one, "p_partkey long, p_size int")


@query("X05", "SELECT 'name:' || p_name || chr(9) || 'age:' || p_size AS value FROM part")
def row_label(t):
    return t.part.select(labelled(name="p_name", age="p_size").alias("value"))


@query(
    "X06",
    """
    SELECT p_partkey, '{"name":"' || p_name || '","age":' || p_size || '}' AS v FROM part
    """,
)
def row_to_json(t):
    return t.part.select("p_partkey", json_object(name="p_name", age="p_size").alias("v"))


@query("X03 U03", "SELECT event_id, upper(event_type) AS u FROM events")
def str_upper(t):
    return t.events.select("event_id", F.upper("event_type").alias("u"))


@query("X02 U01", "SELECT page_id, length(url) AS n FROM pages")
def str_length(t):
    return t.pages.select("page_id", F.length("url").cast("long").alias("n"))


@query("X04 S08", "SELECT p_name AS name, CAST(p_size AS BIGINT) AS age FROM part")
def parse_line(t):
    text = t.part.select(F.concat_ws(", ", "p_name", F.col("p_size").cast("string")).alias("line"))
    person = T.StructType([T.StructField("name", T.StringType()), T.StructField("age", T.LongType())])
    return parse_delimited(text, "line", person)


@query(
    "T06",
    "SELECT o_orderkey FROM orders WHERE "
    "CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) < 429496729",
)
def hash_sample_orders(t):
    return hash_sample(t.orders, "o_orderkey", 0.1).select("o_orderkey")
