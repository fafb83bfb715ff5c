"""Joins and co-grouping."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.operators.grouping import count_by_key
from weft.operators.joins import cogroup_chunks, equi_join
from weft.plans.registry import query


@query(
    "J01",
    "SELECT c_custkey, c_name, o_orderkey FROM customer JOIN orders ON c_custkey = o_custkey",
)
def inner_join(t):
    customers = t.customer.select("c_custkey", "c_name")
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return equi_join(customers, orders, ["c_custkey"])


@query(
    "J01",
    "SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey "
    "JOIN orders ON o_custkey = c_custkey GROUP BY 1",
)
def join_then_count(t):
    per_customer = count_by_key(t.orders.select(F.col("o_custkey").alias("c_custkey")), "c_custkey")
    nations = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    customers = t.customer.select("c_custkey", "c_nationkey")
    # Orders are counted per customer before they meet the other tables.
    joined = customers.join(per_customer, "c_custkey").join(nations, "c_nationkey")
    return joined.groupBy("n_name").agg(F.sum("n").alias("n"))


@query(
    "J02",
    "SELECT c_custkey, event_id FROM customer LEFT JOIN events ON c_custkey = user_id",
)
def left_join(t):
    events = t.events.select(F.col("user_id").alias("c_custkey"), "event_id")
    return equi_join(t.customer.select("c_custkey"), events, ["c_custkey"], "left")


@query(
    "J03",
    "SELECT d.doc_id, quality FROM labels l RIGHT JOIN documents d ON l.doc_id = d.doc_id",
)
def right_join(t):
    labels = t.labels.select("doc_id", "quality")
    return equi_join(labels, t.documents.select("doc_id"), ["doc_id"], "right")


@query(
    "J04",
    "SELECT coalesce(c_custkey, user_id) AS k, c_name, event_id "
    "FROM customer FULL JOIN events ON c_custkey = user_id",
)
def full_join(t):
    customers = t.customer.select(F.col("c_custkey").alias("k"), "c_name")
    events = t.events.select(F.col("user_id").alias("k"), "event_id")
    return equi_join(customers, events, ["k"], "full")


@query(
    "J01 J04",
    "SELECT p_partkey AS k, p_name, l_orderkey, l_linenumber FROM part "
    "FULL JOIN lineitem ON p_partkey = l_partkey",
)
def hot_key_join(t):
    parts = t.part.select(F.col("p_partkey").alias("k"), "p_name")
    lines = t.lineitem.select(F.col("l_partkey").alias("k"), "l_orderkey", "l_linenumber")
    # A low limit, so that the split path runs on these tables too.
    return equi_join(parts, lines, ["k"], "full", hot_rows=40)


@query(
    "J05",
    """
    WITH c AS (SELECT c_nationkey AS k, c_custkey AS v,
        (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 50 AS chunk
        FROM customer),
    s AS (SELECT s_nationkey AS k, s_suppkey AS v,
        (row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1) // 50 AS chunk
        FROM supplier),
    cl AS (SELECT k, chunk, string_agg(v, ',' ORDER BY v) AS l FROM c GROUP BY 1, 2),
    sl AS (SELECT k, chunk, string_agg(v, ',' ORDER BY v) AS r FROM s GROUP BY 1, 2)
    SELECT coalesce(cl.k, sl.k) AS k, coalesce(cl.chunk, sl.chunk) AS chunk,
           coalesce(l, '') AS l, coalesce(r, '') AS r
    FROM cl FULL JOIN sl ON cl.k = sl.k AND cl.chunk = sl.chunk
    """,
)
def cogroup(t):
    customers = t.customer.select(F.col("c_nationkey").alias("k"), "c_custkey")
    suppliers = t.supplier.select(F.col("s_nationkey").alias("k"), "s_suppkey")
    groups = cogroup_chunks(customers, suppliers, ["k"], "c_custkey", "s_suppkey", chunk_rows=50)
    return groups.select(
        "k", "chunk", F.array_join("left", ",").alias("l"), F.array_join("right", ",").alias("r")
    )
