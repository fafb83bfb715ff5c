"""User-defined scalar, aggregate and table functions."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from weft.functions.registered import register_python_functions, register_sql_functions, sessions, token_rows
from weft.operators.typed_aggregate import aggregate_with, average
from weft.plans.registry import query

TOKENS = """
    SELECT conv_id, turn, CAST(unnest(range(len(w))) AS INT) AS pos, unnest(w) AS word
    FROM (SELECT conv_id, turn, string_split(text, ' ') AS w FROM conversations)
"""


@query("U01 U02", "SELECT page_id, length(url) AS n, upper(url) AS u FROM pages")
def sql_udf_length(t):
    register_sql_functions(t.spark)
    t.pages.createOrReplaceTempView("weft_pages")
    return t.spark.sql(
        "SELECT page_id, CAST(str_length(url) AS BIGINT) AS n, str_upper(url) AS u FROM weft_pages"
    )


@query("U01 U03", "SELECT event_id, upper(event_type) AS u, length(event_type) AS n FROM events")
def registered_py_udf(t):
    register_python_functions(t.spark)
    t.events.createOrReplaceTempView("weft_events")
    return t.spark.sql(
        "SELECT event_id, py_upper(event_type) AS u, py_length(event_type) AS n FROM weft_events"
    )


@query(
    "U07 U10",
    "SELECT l_returnflag, round(avg(l_quantity), 6) AS v FROM lineitem GROUP BY 1",
)
def udaf_two_phase_avg(t):
    groups = aggregate_with(t.lineitem, ["l_returnflag"], "l_quantity", average(), name="v")
    return groups.select("l_returnflag", F.round("v", 6).alias("v"))


@query("U07 U10", "SELECT l_orderkey, round(avg(l_quantity), 6) AS v FROM lineitem GROUP BY 1")
def udaf_two_phase_by_order(t):
    groups = aggregate_with(t.lineitem, ["l_orderkey"], "l_quantity", average(), name="v")
    return groups.select("l_orderkey", F.round("v", 6).alias("v"))


@query("U10", "SELECT round(avg(l_quantity), 6) AS v FROM lineitem")
def udaf_two_phase_global(t):
    return aggregate_with(t.lineitem, [], "l_quantity", average(), name="v").select(
        F.round("v", 6).alias("v")
    )


@query(
    "U07 U10",
    "SELECT event_type, shard, round(avg(value), 6) AS v FROM ("
    "SELECT event_type, CAST(user_id % 7 AS VARCHAR) AS shard, value FROM events) GROUP BY 1, 2",
)
def udaf_by_map(t):
    """Maps are one key whatever the order of their entries."""
    kind = [F.lit("type"), F.col("event_type")]
    shard = [F.lit("shard"), (F.col("user_id") % 7).cast("string")]
    turned = F.when(F.col("event_id") % 2 == 0, F.create_map(*kind, *shard)).otherwise(F.create_map(*shard, *kind))
    groups = aggregate_with(t.events.select(turned.alias("m"), "value"), ["m"], "value", average(), name="v")
    return groups.select(F.col("m")["type"].alias("event_type"), F.col("m")["shard"].alias("shard"), F.round("v", 6).alias("v"))


@query("U11", TOKENS)
def udtf_tokens(t):
    return t.conversations.select(
        "conv_id", "turn", F.posexplode(F.split("text", " ")).alias("pos", "word")
    )


@query("U11", TOKENS)
def udtf_class_tokens(t):
    return token_rows(t.conversations.select("conv_id", "turn", "text"), "text")


@query(
    "U11",
    """
    WITH marked AS (
        SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 2 DAY THEN 0 ELSE 1 END AS starts
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
    ),
    numbered AS (
        SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id)::BIGINT AS session FROM marked
    )
    SELECT user_id, session, min(ts) AS started, max(ts) AS ended, count(*) AS n, round(sum(value), 4) AS total
    FROM numbered GROUP BY 1, 2
    """,
)
def udtf_sessions(t):
    found = sessions(t.events, ["user_id"], "ts", "value", datetime.timedelta(days=2), ["event_id"])
    return found.withColumn("total", F.round("total", 4))
