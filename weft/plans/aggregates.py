"""Counts, grouped and global aggregates, group contents, statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.functions import aggregates as own
from weft.operators.grouping import (
    aggregate,
    count_by_key as keyed_counts,
    count_by_value as value_counts,
    describe,
    group_chunks,
    group_rows_by,
    reduce_by_key as reduced,
    summary,
)
from weft.operators.ordering import quantile_sketches, quantile_table, quantiles
from weft.plans.registry import labelled_documents, query
from weft.sources.scratch import stored

LABELLED = "documents LEFT JOIN labels USING (doc_id)"



@query("A01", "SELECT count(*) AS n FROM lineitem")
def row_count(t):
    return t.lineitem.agg(F.count(F.lit(1)).alias("n"))


@query("A02", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def group_count(t):
    return keyed_counts(t.orders, "o_orderstatus")


@query("A02", f"SELECT quality, count(*) AS n FROM {LABELLED} GROUP BY 1")
def group_count_nulls(t):
    return keyed_counts(labelled_documents(t), "quality")


@query(
    "A03 A04 A05 A07",
    "SELECT p_brand, max(p_size) AS mx, min(p_size) AS mn, round(avg(p_size), 6) AS av "
    "FROM part GROUP BY 1",
)
def group_max_min_avg(t):
    return t.part.groupBy("p_brand").agg(
        F.max("p_size").alias("mx"),
        F.min("p_size").alias("mn"),
        F.round(F.avg("p_size"), 6).alias("av"),
    )


@query(
    "A03 A05",
    f"SELECT source, max(quality) AS mx, round(avg(quality), 6) AS av FROM {LABELLED} GROUP BY 1",
)
def group_skips_nulls(t):
    return labelled_documents(t).groupBy("source").agg(
        F.max("quality").alias("mx"), F.round(F.avg("quality"), 6).alias("av")
    )


@query(
    "A06",
    "SELECT c_mktsegment, max(c_nationkey) AS mx, min(c_nationkey) AS mn, "
    "min(c_custkey) AS first_key FROM customer GROUP BY 1",
)
def group_agg_pairs(t):
    return aggregate(
        t.customer,
        ["c_mktsegment"],
        [("c_nationkey", "max", "mx"), ("c_nationkey", "min", "mn"), ("c_custkey", "min", "first_key")],
    )


@query(
    "A08",
    "SELECT l_suppkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q FROM lineitem GROUP BY 1",
)
def reduce_by_key(t):
    pairs = t.lineitem.select("l_suppkey", F.col("l_quantity").cast("long").alias("v"))
    return reduced(pairs, ["l_suppkey"], "v", "sum", "q")


@query(
    "A08 Z02",
    "SELECT l_partkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q FROM lineitem GROUP BY 1",
)
def reduce_in_two_tasks(t):
    pairs = t.lineitem.select("l_partkey", F.col("l_quantity").cast("long").alias("v"))
    return reduced(pairs, ["l_partkey"], "v", "sum", "q", partitions=2)


@query(
    "Z01 A02",
    "SELECT 'event' AS field, event_type AS v, count(*) AS n FROM events GROUP BY 2 "
    "UNION ALL SELECT 'user', CAST(user_id AS VARCHAR), count(*) FROM events GROUP BY 2",
)
def counts_of_a_cached_scan(t):
    """Both counts read the cached columns; the result is stored before they go."""
    rows = t.events.select("event_type", "user_id").persist()
    try:
        events = keyed_counts(rows, F.lit("event").alias("field"), F.col("event_type").alias("v"))
        users = keyed_counts(rows, F.lit("user").alias("field"), F.col("user_id").cast("string").alias("v"))
        return stored(events.unionByName(users), "counts")
    finally:
        rows.unpersist()


@query("A09", "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1")
def count_by_key(t):
    return keyed_counts(t.lineitem, "l_returnflag")


@query("A10", "SELECT event_type, user_id, count(*) AS n FROM events GROUP BY 1, 2")
def count_by_value(t):
    return value_counts(t.events.select("event_type", "user_id"))


@query(
    "A11",
    "SELECT CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q FROM lineitem",
)
def global_reduce(t):
    return reduced(t.lineitem.select(F.col("l_quantity").cast("long").alias("v")), [], "v", "sum", "q")


@query("A12", "SELECT CAST(coalesce(sum(p_size), 0) AS BIGINT) AS q FROM part")
def fold_neutral(t):
    return t.part.agg(own.fold("p_size", "sum", 0).alias("q"))


@query(
    "A13 O05",
    "SELECT o_custkey, CAST(0 AS BIGINT) AS chunk, "
    "array_to_string(list_sort(list(o_orderkey)), ',') AS ks FROM orders GROUP BY 1",
)
def group_values_sorted(t):
    groups = group_chunks(t.orders, ["o_custkey"], "o_orderkey")
    return groups.select("o_custkey", "chunk", F.array_join("values", ",").alias("ks"))


@query(
    "A13 O05",
    """
    SELECT l_returnflag, chunk, count(*) AS n, string_agg(p, ',' ORDER BY p) AS ps FROM (
      SELECT l_returnflag, l_partkey AS p,
             (row_number() OVER (PARTITION BY l_returnflag ORDER BY l_partkey) - 1) // 1000 AS chunk
      FROM lineitem)
    GROUP BY 1, 2
    """,
)
def group_values_hot(t):
    # A low limit, so that the way of hot keys runs on these tables too.
    groups = group_chunks(t.lineitem, ["l_returnflag"], "l_partkey", chunk_rows=1000, hot_rows=500)
    return groups.select(
        "l_returnflag",
        "chunk",
        F.size("values").cast("long").alias("n"),
        F.array_join("values", ",").alias("ps"),
    )


@query(
    "A14",
    """
    SELECT k, chunk, string_agg(o_orderkey || o_orderpriority, '|' ORDER BY o_orderkey) AS vs FROM (
      SELECT substr(o_orderpriority, 1, 1) AS k, o_orderkey, o_orderpriority,
             (row_number() OVER (PARTITION BY substr(o_orderpriority, 1, 1) ORDER BY o_orderkey)
              - 1) // 500 AS chunk
      FROM orders)
    GROUP BY 1, 2
    """,
)
def group_by_expr(t):
    rows = t.orders.select("o_orderkey", "o_orderpriority")
    groups = group_rows_by(rows, F.substring("o_orderpriority", 1, 1), name="k", chunk_rows=500)
    texts = F.transform(
        "values", lambda r: F.concat(r["o_orderkey"].cast("string"), r["o_orderpriority"])
    )
    return groups.select("k", "chunk", F.array_join(texts, "|").alias("vs"))


@query(
    "A20",
    """
    SELECT 'p_size' AS field, count(p_size) AS n, round(avg(p_size), 6) AS mean,
           round(stddev_samp(p_size), 6) AS sd, CAST(min(p_size) AS VARCHAR) AS lowest,
           CAST(max(p_size) AS VARCHAR) AS highest FROM part
    UNION ALL
    SELECT 'p_name', count(p_name), NULL, NULL, min(p_name), max(p_name) FROM part
    """,
)
def describe_stats(t):
    return describe(t.part, ["p_size", "p_name"]).select(
        "field", "n", F.round("mean", 6).alias("mean"), F.round("sd", 6).alias("sd"),
        "lowest", "highest",
    )


@query(
    "A21",
    "SELECT quantile_disc(l_extendedprice, 0.25) AS q25, quantile_disc(l_extendedprice, 0.5) AS q50, "
    "quantile_disc(l_extendedprice, 0.75) AS q75 FROM lineitem",
)
def summary_quartiles(t):
    shares = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    return quantiles(t.lineitem, "l_extendedprice", shares)


@query(
    "A21",
    """
    SELECT 'p_size' AS field, count(p_size) AS n, min(p_size) AS lowest, max(p_size) AS highest,
           quantile_disc(p_size, 0.5) AS q50 FROM part
    UNION ALL
    SELECT 'p_partkey', count(p_partkey), min(p_partkey), max(p_partkey),
           quantile_disc(p_partkey, 0.5) FROM part
    """,
)
def summary_table(t):
    table = summary(t.part, ["p_size", "p_partkey"], {"q50": 0.5})
    return table.select(
        "field", "n", *[F.col(c).cast("long").alias(c) for c in ("lowest", "highest", "q50")]
    )


@query(
    "A21",
    """
    SELECT 'l_partkey' AS field, quantile_disc(l_partkey, 0.1)::DOUBLE AS q10,
           quantile_disc(l_partkey, 0.9)::DOUBLE AS q90 FROM lineitem
    UNION ALL
    SELECT 'l_extendedprice', quantile_disc(l_extendedprice, 0.1), quantile_disc(l_extendedprice, 0.9) FROM lineitem
    """,
)
def quantiles_of_stored_sketches(t):
    """Sketches of parts of the table, stored apart, are merged and settled in one scan."""
    columns = ["l_partkey", "l_extendedprice"]
    parts = [t.lineitem.filter(F.col("l_returnflag").isin(*flags)) for flags in (["A"], ["N", "R"])]
    kept = [stored(quantile_sketches(part, columns), "sketches") for part in parts]
    table = quantile_table(t.lineitem, columns, {"q10": 0.1, "q90": 0.9}, sketches=kept[0].unionByName(kept[1]))
    number = lambda q: F.coalesce(*[F.col(f"{q}.{f.name}").cast("double") for f in table.schema[q].dataType.fields])
    return table.select("field", number("q10").alias("q10"), number("q90").alias("q90"))


@query(
    "A20 A21",
    """
    WITH c AS (
        SELECT 'l_quantity' AS field, l_quantity AS v FROM lineitem
        UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM lineitem
        UNION ALL SELECT 'l_discount', l_discount FROM lineitem
        UNION ALL SELECT 'l_tax', l_tax FROM lineitem
    )
    SELECT field, count(v) AS n, min(v) AS lowest, max(v) AS highest, quantile_disc(v, 0.25) AS q25,
           quantile_disc(v, 0.5) AS q50, quantile_disc(v, 0.75) AS q75 FROM c GROUP BY 1
    """,
)
def summary_of_four(t):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    numbers = [F.col(c).cast("double").alias(c) for c in ("lowest", "highest", "q25", "q50", "q75")]
    return summary(t.lineitem, columns).select("field", "n", *numbers)


@query("U04", f"SELECT lang, count(quality) AS n FROM {LABELLED} GROUP BY 1")
def udaf_count(t):
    return labelled_documents(t).groupBy("lang").agg(own.count_values("quality").alias("n"))


@query(
    "U05 U09",
    "SELECT c_custkey, CAST(greatest(coalesce(max(floor(c_acctbal)), 0), 0) AS BIGINT) AS v "
    "FROM customer GROUP BY 1",
)
def udaf_max_floor0(t):
    balance = F.floor("c_acctbal").cast("long")
    return t.customer.groupBy("c_custkey").agg(own.max_or_zero(balance).cast("long").alias("v"))


@query(
    "U06",
    f"SELECT lang, source, CAST(coalesce(sum(quality), 0) AS BIGINT) AS v FROM {LABELLED} GROUP BY 1, 2",
)
def udaf_sum0(t):
    return labelled_documents(t).groupBy("lang", "source").agg(own.sum_or_zero("quality").alias("v"))


@query(
    "U07",
    f"SELECT lang, source, coalesce(CAST(round(avg(quality) * 1000000) AS BIGINT), -1) AS v "
    f"FROM {LABELLED} GROUP BY 1, 2",
)
def udaf_average(t):
    groups = (
        labelled_documents(t)
        .groupBy("lang", "source")
        .agg(own.average_or_nan("quality").alias("a"))
    )
    millionths = F.round(F.col("a") * 1000000).cast("long")
    return groups.select("lang", "source", F.when(F.isnan("a"), -1).otherwise(millionths).alias("v"))


@query("U08", "SELECT p_brand, CAST(sum(p_size) // count(p_size) AS BIGINT) AS v FROM part GROUP BY 1")
def udaf_int_avg(t):
    return t.part.groupBy("p_brand").agg(own.whole_average("p_size").alias("v"))
