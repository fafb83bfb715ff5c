"""SimHash near-duplicates: exact pairs within a Hamming distance by vantage points.

Equal fingerprints are one node. Nodes are split by their distance to vantage
points: a node at most the median distance away lies inside, any other outside. Two
nodes that link differ in that distance by at most the radius, so an inner node
closer to the border than the radius is also handed to the outer side, and no link
crosses a border unseen. The first levels, with one vantage point each, deal nodes
out to shards, once by the distance in the low half of the bits and once in the high
half: nodes that link differ in one half by at most half the radius, so few lie at a
border. Shards that come out large are dealt again. Within a shard the splitting goes on
down to small blocks. Links are reduced to a tree per shard, and the trees are joined to
components.
"""

from __future__ import annotations

import math
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.common import kept, map_rows, uniform, utf8
from weft.llm.exact import place_name, placed

SHINGLE, SEED, RADIUS = 3, 42, 3
SHARD_NODES = 8_192
MOST_NODES = 65_536
BLOCK = 512
SAMPLE = 4_096
HASHED_AT_ONCE = 200_000


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of a UTF-8 text, unsigned."""
    from xxhash import xxh64_intdigest

    words = data.lower().split()  # of bytes: ASCII letters and white space only
    if not words:
        return 0
    if len(words) < shingle:
        grams = iter([b" ".join(words)])
    else:
        grams = map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
    total = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for begin in range(0, total, HASHED_AT_ONCE):
        count = min(HASHED_AT_ONCE, total - begin)
        hashes = np.fromiter(map(xxh64_intdigest, grams, repeat(SEED, count)), np.uint64, count)
        ones += _bit_counts(hashes)
    bits = np.packbits(2 * ones > total, bitorder="little")
    return int(bits.view(np.uint64)[0])


def _bit_counts(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def add_fingerprint(df: DataFrame, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``fingerprint`` as a signed long; texts without words have 0."""

    def run(texts: pa.Array) -> list[pa.Array]:
        data, bounds = utf8(texts)
        values = [fingerprint(data[a:b]) for a, b in zip(bounds, bounds[1:])]
        return [pa.array(np.array(values, np.uint64).view(np.int64))]

    return map_rows(df, [text], "fingerprint long", run, keep=keep)


def distances(values: np.ndarray, point) -> np.ndarray:
    return np.bitwise_count(values ^ point)


class Vantage(NamedTuple):
    """Nodes at most ``border`` away from ``point``, in the bits of ``mask``, lie inside.

    Nodes that have to meet differ in at most ``radius`` of these bits.
    """

    point: int
    mask: int
    radius: int
    border: int

    def distances(self, values: np.ndarray) -> np.ndarray:
        return distances(values & np.uint64(self.mask), np.uint64(self.point & self.mask)).astype(int)


def halves(radius: int) -> list[tuple[int, int]]:
    """Masks with a radius each: two nodes that link are that close under one of them."""
    low = (1 << 32) - 1
    return [(low, radius // 2), (low << 32, radius // 2)]


def choose_vantages(sample: np.ndarray, levels: int, metrics: list[tuple[int, int]]) -> list[Vantage]:
    """A vantage for each level, taken one after the other from random points.

    Each is the one that leaves the least sum of squared shard sizes in the sample, so
    it cuts the largest shards and has few nodes at its border.
    """
    rng = np.random.default_rng(11)
    tried = []
    for point in rng.choice(sample, min(len(sample), 2 * levels + 8), replace=False):
        for mask, radius in metrics:
            d = Vantage(int(point), mask, radius, 0).distances(sample)
            middle = int(np.median(d))
            tried += [(Vantage(int(point), mask, radius, b), d) for b in (middle - 1, middle, middle + 1)]
    rows, codes, chosen = np.arange(len(sample)), np.zeros(len(sample), np.int64), []
    for _ in range(levels):

        def load(one: tuple[Vantage, np.ndarray]) -> int:
            d, count = one[1][rows], codes.max() + 1
            inner = np.bincount(codes[d <= one[0].border], minlength=count)
            outer = np.bincount(codes[d > one[0].border - one[0].radius], minlength=count)
            return int((inner**2).sum() + (outer**2).sum())

        best = min(tried, key=load)
        chosen.append(best[0])
        rows, codes = _cut(rows, codes, best[1][rows], best[0])
        codes = np.unique(codes, return_inverse=True)[1].ravel()
    return chosen


def _cut(rows: np.ndarray, codes: np.ndarray, d: np.ndarray, vantage: Vantage):
    both = (d <= vantage.border) & (d > vantage.border - vantage.radius)
    codes = 2 * codes + (d > vantage.border)
    return np.concatenate([rows, rows[both]]), np.concatenate([codes, codes[both] + 1])


def shards_of(values: np.ndarray, vantages: list[Vantage], first: int = 0):
    """Row numbers and shard numbers; a node at borders is in several shards. ``first``
    leads the numbers, to tell several series of vantages apart."""
    rows, codes = np.arange(len(values)), np.full(len(values), first, np.int64)
    for vantage in vantages:
        rows, codes = _cut(rows, codes, vantage.distances(values[rows]), vantage)
    return rows, codes


class _Sets:
    """Disjoint sets of numbers."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, members: np.ndarray) -> np.ndarray:
        roots = self.parent[members]
        while True:
            above = self.parent[roots]
            if np.array_equal(above, roots):
                self.parent[members] = roots
                return roots
            roots = above

    def join(self, members: np.ndarray) -> None:
        """Makes all ``members`` one set."""
        roots = self.roots(members)
        self.parent[roots] = roots.min()


def link_nodes(values: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each fingerprint the number of its component's first member."""
    sets = _Sets(len(values))
    stack = [np.arange(len(values))]
    while stack:
        members = stack.pop()
        if len(members) > BLOCK:
            point = values[members[len(members) // 2]]
            d = distances(values[members], point).astype(int)
            sets.join(members[d <= radius])
            border = int(np.median(d))
            inner, outer = members[d <= border], members[d > border - radius]
            # Where nearly all nodes lie at the border, a split saves nothing; a side
            # that keeps all would be split the same way again, without end.
            both, larger = len(inner) + len(outer), max(len(inner), len(outer))
            if both < 1.6 * len(members) and larger < 0.95 * len(members):
                stack += [inner, outer]
                continue
        _link_block(values, members, sets, radius)
    return sets.roots(np.arange(len(values)))


def _link_block(values: np.ndarray, members: np.ndarray, sets: _Sets, radius: int) -> None:
    """Compares members, but none with its own kind of the commonest set.

    ``open`` members are still to be compared; those done have met all others. In a
    dense crowd a block or two links nearly all, and little stays open.
    """
    open_, left = members, members
    while len(open_):
        roots = sets.roots(left)
        names, counts = np.unique(roots, return_counts=True)
        if counts.max() > 1:
            open_ = open_[sets.roots(open_) != names[counts.argmax()]]
        part, open_ = open_[:BLOCK], open_[BLOCK:]
        for at in range(0, len(left), 8 * BLOCK):
            other = left[at : at + 8 * BLOCK]
            hits = np.bitwise_count(values[part][:, None] ^ values[other][None]) <= radius
            for i in np.flatnonzero(hits.sum(axis=1) > (part[:, None] == other[None]).sum(axis=1)):
                sets.join(np.append(other[hits[i]], part[i]))
        left = np.setdiff1d(left, part, assume_unique=True)


def dealt_nodes(nodes: DataFrame, count: int, radius: int = RADIUS) -> DataFrame:
    """``(shard, fingerprint)``: any two nodes that link are in one shard at least.

    Each half of the bits deals out all nodes by vantage points of its own. Only a bounded
    sample, from which the points are taken, reaches the driver. Shards are then counted,
    and one of more than MOST_NODES nodes is dealt again.
    """
    if count <= SHARD_NODES:
        return nodes.select(F.lit(0).cast("long").alias("shard"), "fingerprint")
    # A half of evenly spread nodes keeps about 0.57 of them, those at the border included.
    levels = math.ceil(math.log(count / SHARD_NODES) / math.log(1.75))
    drawn = nodes.filter(uniform("fingerprint") < min(1.0, 2 * SAMPLE / count)).limit(4 * SAMPLE).toPandas()
    sample = np.sort(drawn["fingerprint"].to_numpy()).view(np.uint64)
    series = [choose_vantages(sample, levels, [metric]) for metric in halves(radius)]

    def deal(batches):
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            for half, vantages in enumerate(series):
                rows, codes = shards_of(values, vantages, half)
                columns = [pa.array(codes), pa.array(np.full(len(rows), half, np.int32))]
                columns.append(pa.array(values[rows].view(np.int64)))
                yield pa.RecordBatch.from_arrays(columns, ["shard", "half", "fingerprint"])

    dealt = nodes.select("fingerprint").mapInArrow(deal, "shard long, half int, fingerprint long")
    return _bounded(kept(dealt, "shards"), radius)


def _bounded(dealt: DataFrame, radius: int) -> DataFrame:
    """Shards of at most MOST_NODES nodes.

    A larger one is split in two at a vantage point from a sample of its own, again
    and again. If no point cuts it, as in a dense crowd, it is dealt into pieces by hash, and
    each pair of pieces becomes a shard. All of it is done for all large shards at once.
    """
    most, sampled, ready = MOST_NODES, SAMPLE, []

    def choose(table: pa.Table) -> pa.Table:
        sample = np.sort(table.column("fingerprint").to_numpy()).view(np.uint64)
        metrics = [halves(radius)[table.column("half")[0].as_py()], ((1 << 64) - 1, radius)]
        vantage = choose_vantages(sample, 1, metrics)[0]
        d = vantage.distances(sample)
        larger = max((d <= vantage.border).mean(), (d > vantage.border - vantage.radius).mean())
        pieces = 0 if larger < 0.8 else math.ceil(4 * table.column("nodes")[0].as_py() / most)
        signed = np.array([vantage.point, vantage.mask], np.uint64).view(np.int64).tolist()
        row = [table.column("shard")[0].as_py(), *signed, vantage.border, vantage.border - vantage.radius, pieces]
        return pa.table({name: [value] for name, value in zip(_SPLIT, row)})

    while True:
        sizes = dealt.groupBy("shard").agg(F.count(F.lit(1)).alias("nodes")).filter(F.col("nodes") > most)
        large = kept(sizes, "large-shards")
        if large.isEmpty():
            break
        ready.append(dealt.join(large, "shard", "left_anti"))
        crowded = dealt.join(large, "shard")
        drawn = crowded.filter(uniform("fingerprint", "shard") < sampled / F.col("nodes"))
        splits = kept(drawn.groupBy("shard").applyInArrow(choose, ", ".join(f"{n} long" for n in _SPLIT)), "splits")
        cut = kept(dealt.join(splits, "shard"), "crowded")
        piece = F.pmod(F.xxhash64("fingerprint", F.lit(7)), "pieces")
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).alias("other")
        pairs = cut.filter("pieces > 0").select("*", piece.alias("piece"), other).filter("piece <> other")
        number = F.xxhash64("shard", F.least("piece", "other"), F.greatest("piece", "other"))
        ready.append(pairs.select(number.alias("shard"), "half", "fingerprint"))
        away = F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("point")).bitwiseAND(F.col("mask")))
        sides = F.array(F.when(away <= F.col("inside"), 0), F.when(away > F.col("outside"), 1))
        split = cut.filter("pieces = 0").withColumn("side", F.explode(F.array_compact(sides)))
        number = F.xxhash64("shard", "side", "point", "mask")
        dealt = kept(split.select(number.alias("shard"), "half", "fingerprint"), "shards")
    for part in ready:
        dealt = dealt.unionByName(part)
    return dealt.select("shard", "fingerprint")


_SPLIT = ["shard", "point", "mask", "inside", "outside", "pieces"]


def near_links(nodes: DataFrame, count: int, radius: int = RADIUS) -> DataFrame:
    """``(u, v)``: trees over the nodes that link, with ``v`` the smaller end; ``nodes``
    has distinct fingerprints."""

    def link(table: pa.Table) -> pa.Table:
        values = np.unique(table.column("fingerprint").to_numpy())
        first = link_nodes(values.view(np.uint64), radius)
        linked = first != np.arange(len(values))
        return pa.table({"u": values[linked], "v": values[first[linked]]})

    dealt = dealt_nodes(nodes, count, radius)
    return dealt.groupBy("shard").applyInArrow(link, "u long, v long")


def join_trees(links: DataFrame) -> DataFrame:
    """``(u, v)``: every linked node with the smallest node of its component.

    Stars are exchanged between neighbours until they no longer change: first each
    node hands its larger neighbours to its smallest one, then its smaller ones. The
    number of rounds grows with the logarithm of a component's width. A round is
    written to scratch, so lineage stays short and a lost executor costs little.
    """
    links = kept(links.distinct(), "links")
    before = _stamp(links)
    while before[0]:
        ends = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = ends.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = ends.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        moved = small.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = kept(low.withColumnRenamed("m", "v").unionByName(moved).distinct(), "links")
        after = _stamp(links)
        if after == before:
            break
        before = after
    return links


def _stamp(links: DataFrame) -> tuple:
    mark = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(links.agg(F.count(F.lit(1)), mark).first())


def near_components(
    df: DataFrame, *, id: str = "doc_id", text: str = "text", radius: int = RADIUS
) -> DataFrame:
    """``(id, fingerprint, component_id)``, one row per row of ``df``.

    Fingerprints that differ in at most ``radius`` bits link; ``component_id`` is the
    smallest id that links reach. Null and empty texts and texts of white space have
    fingerprint 0, which links like any other. A null id is never the smallest (a
    component of null ids only has a null one). Repeated rows come out as often; an
    empty table gives no rows; other columns are left out.
    """
    rows = df.select(F.col(id).alias("_id"), F.lit(0).alias("_place"), F.col(text).alias("_text"))
    marked, named = _components(rows, radius)
    joined = marked.join(named, "fingerprint", "left")
    return joined.select(F.col("_id").alias(id), "fingerprint", F.col("_best._id").alias("component_id"))


def _components(rows: DataFrame, radius: int) -> tuple[DataFrame, DataFrame]:
    """``(_id, _place, fingerprint)`` of ``(_id, _place, _text)``, and ``(fingerprint,
    _best)``: the first row of a fingerprint's component by id, null last, and place."""
    marked = kept(add_fingerprint(rows, text="_text", keep=["_id", "_place"]), "fingerprints")
    best = F.min(F.struct(F.col("_id").isNull().alias("_none"), "_id", "_place")).alias("_best")
    nodes = kept(marked.groupBy("fingerprint").agg(best), "nodes")
    roots = join_trees(near_links(nodes, nodes.count(), radius))
    roots = roots.select(F.col("u").alias("fingerprint"), F.col("v").alias("_root"))
    rooted = nodes.join(roots, "fingerprint", "left").withColumn("_root", F.coalesce("_root", "fingerprint"))
    lowest = rooted.groupBy("_root").agg(F.min("_best").alias("_best"))
    return marked, rooted.drop("_best").join(lowest, "_root").select("fingerprint", "_best")


def drop_near_copies(
    df: DataFrame, *, id: str = "doc_id", text: str = "text", radius: int = RADIUS
) -> DataFrame:
    """``df`` with one row of each component of near-duplicates; see near_components.

    The row with the smallest id stays, a null id being the largest, and of several rows
    with that id one. Rows are told apart by their place, so a repeated id or a null
    one loses no text that is in no other component. Null and empty texts are one
    component. An empty table gives no rows, and columns of any name stay.
    """
    place = place_name(df)
    rows = placed(df, place)
    given = rows.select(F.col(f"`{id}`").alias("_id"), F.col(place).alias("_place"), F.col(f"`{text}`").alias("_text"))
    marked, named = _components(given, radius)
    gone = marked.join(named, "fingerprint").filter(F.col("_place") != F.col("_best._place"))
    return rows.join(gone.select(F.col("_place").alias(place)), place, "left_anti").select(df.columns)
