"""Sorts, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.operators import ordering as order
from weft.operators import sets
from weft.plans.registry import query


@query("O01", "SELECT * FROM customer ORDER BY c_mktsegment, c_custkey")
def sort_by_key(t):
    return order.sort_by(t.customer, "c_mktsegment", ties=["c_custkey"])


@query(
    "O01 O06",
    "SELECT c_custkey, row_number() OVER (ORDER BY length(c_name), c_acctbal DESC, c_custkey) - 1 "
    "AS position FROM customer",
)
def sort_by_expression(t):
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal")
    laid = order.sort_by(rows, F.length("c_name"), F.desc("c_acctbal"), ties=["c_custkey"])
    return order.with_position(laid).select("c_custkey", "position")


@query("O05", "SELECT o_custkey, o_totalprice, o_orderkey FROM orders")
def sorted_within_keys(t):
    rows = t.orders.select("o_custkey", "o_totalprice", "o_orderkey")
    return order.sorted_within_keys(rows, ["o_custkey"], ["o_totalprice", "o_orderkey"])


@query(
    "O05",
    "SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey "
    "ORDER BY o_totalprice, o_orderkey) - 1 AS position FROM orders",
)
def positions_within_keys(t):
    rows = t.orders.select("o_custkey", "o_totalprice", "o_orderkey")
    laid = order.sorted_within_keys(rows, ["o_custkey"], ["o_totalprice", "o_orderkey"])
    return order.with_position(laid, ["o_custkey"], gathered=True).select("o_custkey", "o_orderkey", "position")


@query("O03", "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_n(t):
    return order.top(t.orders, 10, "o_totalprice", ties=["o_orderkey"])


@query(
    "O03 O04",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS position "
    "FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25",
)
def top_positions(t):
    best = order.top(t.orders, 25, "o_totalprice", ties=["o_orderkey"])
    return order.with_position(best).select("o_orderkey", "position")


@query("O04", "SELECT * FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 10")
def take_ordered(t):
    return order.take_ordered(t.orders, 10, "o_totalprice", "o_orderkey")


@query("O07", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 10")
def head_n(t):
    return order.take_ordered(t.documents.select("doc_id", "lang"), 10, "doc_id")


@query(
    "A13 O05",
    """
    SELECT o_custkey, o_orderkey, CAST(coalesce(sum(w) OVER (
               PARTITION BY o_custkey ORDER BY o_orderkey
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
    FROM (SELECT o_custkey, o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS w FROM orders)
    """,
)
def running_totals(t):
    rows = t.orders.select(
        "o_custkey", "o_orderkey", F.floor("o_totalprice").cast("long").alias("w")
    )
    placed = order.running_totals(rows, ["o_custkey"], ["o_orderkey"], "w")
    return placed.select("o_custkey", "o_orderkey", "start")


@query("E01", "SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier")
def union_all(t):
    return sets.union_all(
        t.customer.select(F.col("c_nationkey").alias("k")), t.supplier.select("s_nationkey")
    )


@query("E02", "SELECT l_partkey AS k FROM lineitem INTERSECT SELECT p_partkey FROM part")
def intersection(t):
    return sets.intersection(
        t.lineitem.select(F.col("l_partkey").alias("k")), t.part.select("p_partkey")
    )


@query("E03", "SELECT DISTINCT event_type, user_id FROM events")
def distinct_values(t):
    return sets.distinct(t.events, "event_type", "user_id")
