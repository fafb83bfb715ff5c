"""Written and re-read data: files, table layouts, catalog tables and views."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.operators.hotkeys import (
    COPIED,
    HOT_ROWS,
    SALT,
    frequent_keys,
    heavy_hitters,
    ignored_rows,
    pieces,
    spread,
)
from weft.plans.registry import labelled_documents, query
from weft.sources.catalog import (
    bucket_count,
    create_table,
    insert,
    merge_buckets,
    save_bucketed,
    save_table,
    scratch_tables,
    truncate,
)
from weft.sources.files import (
    key_between,
    look_up,
    merged_schema_read,
    pair_lines,
    round_trip,
    write_indexed,
    write_keyed,
    write_partitioned,
    write_range_layout,
)
from weft.sources.scratch import scratch_path, stored
from weft.sources.sink import committed, for_each_partition
from weft.sources.tables import (
    query_global_view,
    register_tables,
    sql_on_file as read_by_sql,
)

BYTES_A_ROW = 64


@query(
    "S01 S17",
    "SELECT '(' || o_orderpriority || ',' || o_orderkey || ')' AS value FROM orders",
)
def text_roundtrip(t):
    return round_trip(pair_lines(t.orders, "o_orderpriority", "o_orderkey"), "text")


@query(
    "S04",
    "SELECT doc_id, lang, source, quality FROM documents LEFT JOIN labels USING (doc_id)",
)
def json_roundtrip(t):
    return round_trip(labelled_documents(t).drop("toxic"), "json")


@query(
    "S04",
    "SELECT doc_id, lang, n_chars, quality FROM documents LEFT JOIN labels USING (doc_id)",
)
def json_inferred(t):
    """Whole numbers come back as long, columns by name, a missing key as null."""
    rows = labelled_documents(t).select("doc_id", "lang", F.col("quality").cast("long").alias("q"))
    path = scratch_path(t.spark, "json")
    rows.join(t.documents.select("doc_id", "n_chars"), "doc_id").write.json(path)
    read = t.spark.read.json(path)
    return read.select(*read.columns[:3], F.col("q").cast("int").alias("quality"))


@query("S05", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def csv_inferred(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    path = scratch_path(t.spark, "csv")
    rows.write.csv(path, sep=";", header=True)
    read = t.spark.read.csv(path, sep=";", header=True, inferSchema=True)
    return read.withColumns({c: F.col(c).cast("long") for c in ("o_orderkey", "o_custkey")})


@query(
    "S05",
    "SELECT doc_id, text, lang, source, CAST(quality AS VARCHAR) AS label, "
    "CASE WHEN quality = 1 THEN '' ELSE source END AS note "
    "FROM documents LEFT JOIN labels USING (doc_id)",
)
def csv_text_roundtrip(t):
    """Line ends, quotes and blanks of the texts, nulls and empty texts stay."""
    note = F.when(F.col("quality") == 1, "").otherwise(F.col("source")).alias("note")
    label = F.col("quality").cast("string").alias("label")
    rows = t.documents.join(t.labels, "doc_id", "left")
    return round_trip(rows.select("doc_id", "text", "lang", "source", label, note), "csv")


@query("S05", "SELECT * FROM customer")
def csv_roundtrip(t):
    return round_trip(t.customer, "csv", sep=";", header=True)


@query("S18 S05", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def csv_aggregate(t):
    counts = t.customer.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    return round_trip(counts, "csv")


@query(
    "S06",
    """
    SELECT vec_id, label, CAST(unnest(range(len(embedding))) AS INT) AS pos,
           CAST(round(CAST(unnest(embedding) AS DOUBLE) * 1000000) AS BIGINT) AS millionths
    FROM embeddings
    """,
)
def parquet_array_roundtrip(t):
    vectors = round_trip(t.embeddings)
    cells = vectors.select("vec_id", "label", F.posexplode("embedding").alias("pos", "e"))
    millionths = F.round(F.col("e").cast("double") * 1000000).cast("long")
    return cells.select("vec_id", "label", "pos", millionths.alias("millionths"))


@query("S07", "SELECT * FROM part")
def orc_roundtrip(t):
    options = {"orc.bloom.filter.columns": "p_partkey", "orc.dictionary.key.threshold": "1.0"}
    return round_trip(t.part, "orc", **options)


@query(
    "S07",
    "SELECT * FROM orders WHERE o_orderkey IN ("
    "SELECT l_orderkey FROM lineitem WHERE l_quantity = 50 AND l_tax = 0.08 AND l_discount = 0.1)",
)
def orc_lookup(t):
    """Orders with certain items, from files laid out by customer."""
    path = scratch_path(t.spark, "orc-orders")
    write_indexed(t.orders.repartitionByRange("o_custkey").sortWithinPartitions("o_custkey"), path, "o_orderkey", stride=1000)
    items = t.lineitem.filter("l_quantity = 50 AND l_tax = 0.08 AND l_discount = 0.1")
    return look_up(t.spark.read.orc(path), "o_orderkey", items, column="l_orderkey")


@query("S10", "SELECT * FROM orders")
def sql_on_file(t):
    return read_by_sql(t.spark, f"{t.directory}/orders.parquet")


@query(
    "S11",
    "SELECT c_custkey AS a, c_name AS b, NULL AS c, 1 AS key FROM customer "
    "UNION ALL SELECT s_suppkey, NULL, s_nationkey, 2 FROM supplier",
)
def merge_schema(t):
    root = scratch_path(t.spark, "merged")
    customers = t.customer.select(F.col("c_custkey").alias("a"), F.col("c_name").alias("b"))
    suppliers = t.supplier.select(F.col("s_suppkey").alias("a"), F.col("s_nationkey").alias("c"))
    write_keyed({1: customers, 2: suppliers}, root)
    return merged_schema_read(t.spark, root).select("a", "b", "c", "key")


@query(
    "S12",
    "SELECT doc_id, lang, source, quality FROM documents LEFT JOIN labels USING (doc_id)",
)
def partitioned_write(t):
    path = scratch_path(t.spark, "by-quality")
    write_partitioned(labelled_documents(t).drop("toxic"), path, "quality")
    return t.spark.read.parquet(path)


@query(
    "S12",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'",
)
def partition_pruned_read(t):
    path = scratch_path(t.spark, "by-status")
    write_partitioned(t.orders, path, "o_orderstatus")
    done = t.spark.read.parquet(path).filter(F.col("o_orderstatus") == "F")
    return done.select("o_orderkey", "o_orderstatus")


@query(
    "P09",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity BETWEEN 10 AND 20",
)
def range_layout_filter(t):
    path = scratch_path(t.spark, "by-quantity")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    write_range_layout(rows, path, "l_quantity", ties=["l_orderkey", "l_linenumber"])
    return t.spark.read.parquet(path).filter(key_between("l_quantity", 10.0, 20.0))


@query(
    "S13 S14",
    "SELECT c_custkey, c_name, o_orderkey FROM customer JOIN orders ON c_custkey = o_custkey",
)
def bucketed_join(t):
    customers = t.customer.select("c_custkey", "c_name")
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    # A bucket is read by one task, so a key far above a bucket's share is cut.
    found = heavy_hitters(orders, ["c_custkey"], ignored=ignored_rows(HOT_ROWS))
    summary = stored(found, "frequent-keys")
    buckets = bucket_count((summary.agg(F.sum("_rows")).first()[0] or 0) * BYTES_A_ROW)
    hot, bound, _ = frequent_keys(summary, ["_k0"], buckets, HOT_ROWS)
    hot = hot.select("_k0", pieces(F.col("_n"), bound).alias("_r"), F.lit(1).alias("_l"))
    keys = ["c_custkey", "_l" + SALT, "_r" + SALT]
    with scratch_tables(t.spark) as tables:
        left = spread(customers, ["c_custkey"], hot, "_l", "_r").drop(COPIED)
        right = spread(orders, ["c_custkey"], hot, "_r", "_l").drop(COPIED)
        left = save_bucketed(left, tables.name("customers"), keys, buckets)
        right = save_bucketed(right, tables.name("orders"), keys, buckets)
        return tables.result(left.join(right.hint("merge"), keys).drop(*keys[1:]))


@query(
    "S13",
    "SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_custkey IN ("
    "SELECT c_custkey FROM customer WHERE c_acctbal >= (SELECT max(c_acctbal) FROM customer) - 10)",
)
def bucket_lookup(t):
    """Orders of the richest customers, from the buckets that hold them."""
    best = t.customer.agg(F.max("c_acctbal")).first()[0]
    rich = t.customer.filter(F.col("c_acctbal") >= F.lit(best) - 10)
    rows = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    with scratch_tables(t.spark) as tables:
        saved = save_bucketed(rows, tables.name("orders"), ["o_custkey"], 32)
        return tables.result(look_up(saved, "o_custkey", rich, column="c_custkey"))


@query(
    "S13",
    "SELECT l_orderkey AS orderkey, o_custkey, l_linenumber, l_quantity "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
)
def bucket_merge(t):
    """Orders and their items, merged from sorted buckets."""
    orders = t.orders.select(F.col("o_orderkey").alias("orderkey"), "o_custkey")
    items = t.lineitem.select(F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_quantity")
    with scratch_tables(t.spark) as tables:
        names = [tables.name("orders"), tables.name("items")]
        for rows, name in zip((orders, items), names):
            save_bucketed(rows, name, ["orderkey"], 8)
        return tables.result(merge_buckets(t.spark, *names, ["orderkey"]))


@query(
    "T05",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
)
def partition_effects(t):
    """Orders that tasks have sent off, batch by batch, as their records tell."""
    path = scratch_path(t.spark, "effects")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice").repartition(8, "o_custkey")
    for_each_partition(orders, path)
    return committed(t.spark, path, orders.schema)


@query("S14", "SELECT * FROM supplier")
def saved_table(t):
    with scratch_tables(t.spark) as tables:
        return tables.result(save_table(t.supplier, tables.name("supplier")))


PEOPLE = "name VARCHAR(64), nation INT"


@query(
    "K01 K05 K06 K07 K09",
    "SELECT c_name AS name, c_nationkey AS nation FROM customer "
    "UNION ALL SELECT s_name, s_nationkey FROM supplier",
)
def table_inserts(t):
    with scratch_tables(t.spark) as tables:
        table = create_table(t.spark, tables.name("people"), PEOPLE)
        insert(t.customer.selectExpr("c_name AS name", "c_nationkey AS nation"), table)
        people = insert(t.supplier.selectExpr("s_nationkey AS nation", "s_name AS name"), table)
        return tables.result(people)


@query("K08 K09", "SELECT c_name AS name, c_nationkey AS nation FROM customer")
def truncated_table(t):
    with scratch_tables(t.spark) as tables:
        table = create_table(t.spark, tables.name("people"), PEOPLE)
        insert(t.supplier.selectExpr("s_name AS name", "s_nationkey AS nation"), table)
        truncate(t.spark, table)
        return tables.result(insert(t.customer.selectExpr("c_name AS name", "c_nationkey AS nation"), table))


@query("K10 K11", "SELECT p_partkey, p_size + 1 AS p FROM part")
def global_view_sql(t):
    sql = "SELECT p_partkey, p_size + 1 AS p FROM global_temp.weft_part"
    return query_global_view(t.part, "weft_part", sql)


@query("K10 K11", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def view_sql(t):
    register_tables(t.spark, t.directory, ["orders"], prefix="weft_")
    return t.spark.sql("SELECT o_orderstatus, count(*) AS n FROM weft_orders GROUP BY 1")
