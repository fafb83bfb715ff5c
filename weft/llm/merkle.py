"""Merkle manifest of a table, with a proof for each row, by a butterfly exchange.

Rows of a group are numbered in their order and dealt to partitions of ``fanout ** k``
consecutive ones, so that each partition is a whole subtree. A partition hashes its
subtree to one root. Then partitions exchange roots round by round: in a round each
one holds the node above it, receives the sibling nodes from partners at its own place
in the sibling groups, and hashes the next node, as all members of its group do. After
the last round every partition holds the root and all upper proofs; nothing is sent
down again. Roots of groups are the leaves of a last tree, made the same way.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weft.llm.common import kept
from weft.operators.ordering import running_totals

FANOUT = 2
SPAN = 1 << 14  # most leaves of a partition
ROUNDS_KEPT = 6  # rounds between two written tables
PROOF = "array<struct<before: string, after: string>>"


def field_text(column: Column) -> Column:
    """A value of a leaf: its UTF-8 byte count, a colon and itself; ``-`` for null."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*columns: Column) -> Column:
    return F.sha2(F.concat(F.lit(""), *[field_text(c) for c in columns]).cast("binary"), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings, level by level, give."""
    up = lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]).cast("binary"), 256)
    return F.aggregate(proof, leaf, up)


def siblings_text(proof: Column) -> Column:
    """All siblings of a proof, level by level, left to right, as one text."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), "")


def _parents(nodes: list[str], fanout: int) -> list[str]:
    """Digests of each ``fanout`` consecutive nodes; the last may have fewer."""
    groups = range(0, len(nodes), fanout)
    return [hashlib.sha256("".join(nodes[i : i + fanout]).encode()).hexdigest() for i in groups]


def _levels(nodes: list[str], part: int, height: int, fanout: int) -> list[list[str]]:
    """The levels of a partition's subtree, leaves first. The first partition of a group
    ends at a single node: if it is full that is at ``height``, and if not it is the
    only one. Any other climbs to ``height``, however few leaves it has."""
    levels = [nodes]
    while len(levels) <= height and (part > 0 or len(levels[-1]) > 1):
        levels.append(_parents(levels[-1], fanout))
    return levels


def _beside(nodes: list[str], fanout: int) -> tuple[list[str], list[str]]:
    """Siblings before and behind each node."""
    place = [(i - i % fanout, i) for i in range(len(nodes))]
    before = ["".join(nodes[g:i]) for g, i in place]
    return before, ["".join(nodes[i + 1 : g + fanout]) for g, i in place]


def _placed(df: DataFrame, keys: list[str], order: list[str], span: int) -> DataFrame:
    """``df`` with ``_part`` and ``_slot``: which partition of the key, and where in it."""
    numbered = running_totals(df.withColumn("_unit", F.lit(1)), keys, order, "_unit", name="_slot")
    part = F.expr(f"_slot div {span}")
    return numbered.drop("_unit").select("*", part.alias("_part")).withColumn("_slot", F.col("_slot") % span)


def _subtrees(placed: DataFrame, keys: list[str], height: int, fanout: int) -> DataFrame:
    """``(keys, _part, _node)``: the root of each partition's subtree. A partition has at
    most ``fanout ** height`` leaves, so one task holds it."""
    schema = T.StructType([*[placed.schema[k] for k in keys], *T.StructType.fromDDL("_part long, _node string").fields])

    def root(table: pa.Table) -> pa.Table:
        table = table.sort_by("_slot")
        nodes, part = table.column("_leaf").to_pylist(), table.column("_part")[0].as_py()
        top = _levels(nodes, part, height, fanout)[-1]
        return pa.table(
            [*[table.column(k).slice(0, 1) for k in keys], pa.array([part]), pa.array(top)], schema.names
        )

    slim = placed.select(*keys, "_part", "_slot", "_leaf")
    return slim.groupBy(*keys, "_part").applyInArrow(root, schema)


def butterfly(roots: DataFrame, keys: list[str], fanout: int) -> DataFrame:
    """``(keys, _part, _node, _above)``: the root of the key's tree and the proof of each
    partition's node, from ``(keys, _part, _node)`` with parts numbered from 0.

    In round r a node covers ``fanout ** r`` partitions, all of which hold it. A
    partition sends it to those at its own place in the sibling nodes; the last node
    may cover fewer, so places are taken modulo that number. Each partition gets one
    message for each sibling and one from itself, whatever the size of the tree.
    """
    roots = kept(roots, "merkle-roots")
    counts = roots.groupBy(*keys).agg((F.max("_part") + 1).alias("_parts"))
    most = counts.agg(F.max("_parts")).first()[0] or 1
    rounds = 0
    while fanout**rounds < most:
        rounds += 1
    state = _null_safe(roots, counts, keys)
    state = state.withColumn("_above", F.array().cast(PROOF))
    for r in range(rounds):
        width = fanout**r
        node = F.expr(f"_part div {width}")
        group = F.expr(f"_part div {width * fanout}") * fanout
        nodes = F.ceil(F.col("_parts") / F.lit(width)).cast("long")
        size = lambda q: F.least(F.lit(width).cast("long"), F.col("_parts") - q * width)
        own = F.col("_part") - node * width

        def receivers(q: Column) -> Column:
            """Where in node q this partition's messages go."""
            some = F.sequence(own, F.greatest(own, size(q) - 1), size(node))
            places = F.transform(some, lambda place: q * width + place)
            return F.when((q != node) & (own < size(q)), places).otherwise(F.array().cast("array<long>"))

        nodes_of_group = F.sequence(group, F.least(group + fanout, nodes) - 1)
        to = F.concat(F.flatten(F.transform(nodes_of_group, receivers)), F.array("_part"))
        # A tree of fewer partitions is done: only itself gets its node.
        to = F.when(nodes > 1, to).otherwise(F.array("_part"))
        sent = state.select(
            *keys, "_parts", node.alias("_q"), "_node", F.col("_part").alias("_from"), "_above", F.explode(to).alias("_to")
        )
        mine = F.col("_from") == F.col("_to")
        met = sent.groupBy(*keys, F.col("_to").alias("_part")).agg(
            F.first("_parts").alias("_parts"),
            F.max(F.when(mine, F.col("_q"))).alias("_own"),
            F.max(F.when(mine, F.col("_node"))).alias("_old"),
            F.max(F.when(mine, F.col("_above"))).alias("_below"),
            F.array_sort(F.collect_list(F.struct("_q", "_node"))).alias("_met"),
        )
        texts = lambda side: F.array_join(
            F.transform(F.filter("_met", lambda s: side(s["_q"])), lambda s: s["_node"]), ""
        )
        level = F.struct(
            texts(lambda q: q < F.col("_own")).alias("before"), texts(lambda q: q > F.col("_own")).alias("after")
        )
        climbs = F.ceil(F.col("_parts") / F.lit(width)) > 1
        everyone = F.sha2(texts(lambda q: F.lit(True)).cast("binary"), 256)
        state = met.select(
            *keys,
            "_part",
            F.when(climbs, everyone).otherwise(F.col("_old")).alias("_node"),
            "_parts",
            F.when(climbs, F.concat("_below", F.array(level))).otherwise(F.col("_below")).alias("_above"),
        )
        if r % ROUNDS_KEPT == ROUNDS_KEPT - 1:
            state = kept(state, "merkle-round")
    return kept(state.drop("_parts"), "merkle-state")


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """``left`` with the columns that ``right`` has for its key; a null key matches."""
    renamed = right.select(*[F.col(k).alias(f"_r{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_r{k}"))
    return left.join(renamed, same).drop(*[f"_r{k}" for k in keys])


def _proved(placed: DataFrame, state: DataFrame, keys: list[str], height: int, fanout: int) -> DataFrame:
    """``placed`` with ``_node`` (as the state of its partition says), and ``_proof``:
    siblings in the partition and those above it."""
    stay = [c for c in placed.columns if c not in ("_part", "_slot")]
    more = [c for c in state.columns if c not in (*keys, "_part", "_above")]
    schema = T.StructType(
        [
            *[placed.schema[c] for c in stay],
            *[state.schema[c] for c in more],
            *T.StructType.fromDDL(f"_proof {PROOF}").fields,
        ]
    )

    def prove(rows: pa.Table, held: pa.Table) -> pa.Table:
        rows = rows.sort_by("_slot")
        part, n = rows.column("_part")[0].as_py(), len(rows)
        levels = _levels(rows.column("_leaf").to_pylist(), part, height, fanout)[:-1]
        before, after, at, first = [], [], np.zeros((n, 0), np.int64), 0
        for depth, nodes in enumerate(levels):
            low, high = _beside(nodes, fanout)
            before, after = before + low, after + high
            at = np.c_[at, first + np.arange(n) // fanout**depth]
            first += len(nodes)
        for step in held.column("_above")[0].as_py():  # alike for the whole partition
            before, after = before + [step["before"]], after + [step["after"]]
            at = np.c_[at, np.full(n, first)]
            first += 1
        taken = pa.array(at.ravel())
        steps = pa.StructArray.from_arrays(
            [pa.array(before, pa.string()).take(taken), pa.array(after, pa.string()).take(taken)], ["before", "after"]
        )
        offsets = pa.array(np.arange(n + 1, dtype=np.int32) * at.shape[1])
        values = [pa.array([held.column(c)[0].as_py()] * n, pa.string()) for c in more]
        columns = [*[rows.column(c) for c in stay], *values, pa.ListArray.from_arrays(offsets, steps)]
        return pa.table(columns, schema.names)

    both = placed.groupBy(*keys, "_part").cogroup(state.groupBy(*keys, "_part"))
    return both.applyInArrow(prove, schema)


def _height(span: int, fanout: int) -> int:
    height = int(math.log(span, fanout) + 1e-9)
    if height < 1 or fanout < 2:
        raise ValueError("fanout is at least 2, and a partition holds at least that many leaves")
    return height


def merkle_manifest(
    df: DataFrame,
    *,
    id: str = "doc_id",
    group: str = "lang",
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    keep: list[str] | None = None,
    fanout: int = FANOUT,
    span: int = SPAN,
) -> DataFrame:
    """``keep`` columns (default: id and group) with ``leaf``, ``subroot``, ``root`` and
    ``proof``.

    A leaf is the hex SHA-256 of the ``fields``, each ``-`` if null and else its byte
    count, a colon and the value as text. The leaves of a group are ordered by id, a
    null id first; rows with one id are ordered by leaf, and equal leaves of one id
    may swap their proofs, which then hold either way. While a group has several nodes,
    each ``fanout`` consecutive ones become the digest of their texts; the last of a
    level may have fewer children, even one. What remains is the subroot, a lone leaf
    being its own. Subroots ordered by group, null first and texts by bytes, give the
    root likewise. ``proof`` holds for each level up to the root the siblings before
    and behind the node, joined; see :func:`fold` and :func:`siblings_text`.

    A null group is a group. Texts of any length are hashed where they are read and
    moved nowhere, unless they are kept. An empty table gives no rows. A kept column
    named like an output gives way to it, whatever its case. ``id`` and ``group`` are
    of types that sort.

    A partition has at most ``span`` leaves, the rows of a group of any size are
    numbered by ranges, and messages are one row per partition and sibling. Kept columns
    lie in the task of their partition, so long texts are better joined by id later.
    """
    height = _height(span, fanout)
    outputs = ("leaf", "subroot", "root", "proof")
    stay = [c for c in ([id, group] if keep is None else keep) if c.lower() not in outputs]
    col = lambda c: F.col(f"`{c}`")
    leaves = df.select(
        col(group).alias("_group"),
        col(id).alias("_id"),
        leaf_digest(*[col(f) for f in fields]).alias("_leaf"),
        *[col(c).alias(f"_c{i}") for i, c in enumerate(stay)],
    )
    # Ranges are cut after a look at the rows, which would hash every text twice.
    leaves = kept(leaves, "merkle-leaves")
    placed = _placed(leaves, ["_group"], ["_id", "_leaf"], fanout**height)
    state = butterfly(_subtrees(placed, ["_group"], height, fanout), ["_group"], fanout)
    state = state.withColumnRenamed("_node", "_subroot")
    # The last tree has one leaf for each group.
    tops = state.filter("_part = 0").select("_group", F.col("_subroot").alias("_leaf"))
    tops = _placed(tops.withColumn("_all", F.lit(0)), ["_all"], ["_group"], fanout**height)
    top_state = butterfly(_subtrees(tops, ["_all"], height, fanout), ["_all"], fanout)
    top = _proved(tops, top_state.withColumnRenamed("_node", "_root"), ["_all"], height, fanout)
    over = _null_safe(state, top.select("_group", "_root", F.col("_proof").alias("_over")), ["_group"])
    over = over.withColumn("_above", F.concat("_above", "_over")).drop("_over")
    proved = _proved(placed.drop("_id"), over, ["_group"], height, fanout)
    return proved.select(
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(stay)],
        F.col("_leaf").alias("leaf"),
        F.col("_subroot").alias("subroot"),
        F.col("_root").alias("root"),
        F.col("_proof").alias("proof"),
    )
