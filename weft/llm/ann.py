"""Approximate nearest neighbours by an adaptive scan over dimensions.

Vectors are scaled to length one, rotated at random and assigned to the nearest of a
set of centroids. A query probes the lists of its nearest centroids. In a list the
rotated vectors are compared block of columns by block of columns: as the rotation
spreads a difference evenly, the part seen so far estimates the whole distance, and
a candidate is given up when the estimate exceeds the query's current bound by more
than chance allows. Those that remain are scored exactly on the original vectors.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.llm.common import kept, uniform

SAMPLE_VALUES = 1_500_000  # vectors in the fitting sample, times dimensions
MOST_LISTS = 4096
ROUNDS = 8
PROBED_SHARE = 0.97  # of sampled neighbours that the probed lists must hold
SIGNIFICANCE = 2.1  # in the bound of the hypothesis test
PIECE, QUERY_BLOCK, QUERIES_AT_ONCE = 8192, 4096, 64
SLACK = 1e-9


@dataclass
class Lists:
    """What fitting finds: rotation, centroids (rotated) and lists to probe."""

    rotation: np.ndarray
    centroids: np.ndarray
    probes: int

    def rotated(self, vectors: np.ndarray) -> np.ndarray:
        return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)) @ self.rotation

    def nearest(self, rotated: np.ndarray, count: int) -> np.ndarray:
        """Numbers of the nearest centroids, nearest first."""
        return np.argsort(-(rotated @ self.centroids.T), axis=1, kind="stable")[:, :count]


def usable_vectors(df: DataFrame, id: str, vector: str) -> DataFrame:
    """``(_id, _v)`` of the rows that take part: an id, and a vector without null and
    non-finite components, not all zero."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.filter(F.col(id).isNotNull() & F.col(vector).isNotNull() & sound)
    rows = rows.filter(F.exists(vector, lambda x: x != 0))
    return rows.select(F.col(id).alias("_id"), F.col(vector).cast("array<double>").alias("_v"))


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def fit_lists(vectors: DataFrame, dimension: int, neighbours: int, seed: int = 5) -> Lists:
    """Centroids and the number of lists to probe, from a bounded sample by hash.

    Spherical k-means with about the square root of all rows as number of lists. As
    many lists are probed as hold PROBED_SHARE of the neighbours that sampled queries
    have in the sample.
    """
    count = vectors.count()
    most = max(1000, SAMPLE_VALUES // max(1, dimension))
    drawn = vectors.filter(uniform("_id") < min(1.0, most / max(1, count))).limit(2 * most)
    table = drawn.toArrow().sort_by("_id")
    rng = np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.normal(size=(dimension, dimension)))[0]
    lists = Lists(rotation, np.zeros((1, dimension)), 1)
    if not len(table):
        return lists
    sample = lists.rotated(_matrix(table.column("_v"), dimension))
    number = int(min(MOST_LISTS, max(1, count**0.5), max(1, len(np.unique(sample, axis=0)))))
    centroids = sample[rng.choice(len(sample), number, replace=False)]
    for _ in range(ROUNDS):
        blocks = [sample[i : i + 1024] for i in range(0, len(sample), 1024)]
        owner = np.concatenate([(block @ centroids.T).argmax(axis=1) for block in blocks])
        sums = np.zeros_like(centroids)
        np.add.at(sums, owner, sample)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(length > 1e-12, sums / np.maximum(length, 1e-12), centroids)
    lists.centroids = centroids
    owner = lists.nearest(sample, 1)[:, 0]
    asked = rng.choice(len(sample), min(400, len(sample)), replace=False)
    near = sample[asked] @ sample.T
    near[np.arange(len(asked)), asked] = -np.inf
    found = np.argsort(-near, axis=1)[:, : min(neighbours, max(1, len(sample) - 1))]
    place = np.argsort(lists.nearest(sample[asked], number), axis=1)
    ranks = np.take_along_axis(place, owner[found], axis=1)
    lists.probes = int(np.quantile(ranks, PROBED_SHARE, method="higher")) + 1
    return lists


def scan_list(queries, query_ids, vectors, vector_ids, rotated, k: int) -> Iterator[tuple]:
    """``(query ids, candidate ids, scores)`` of the k best candidates per query.

    ``rotated`` rotates and scales. Rows with the id of the query are no candidates. Of
    equal vectors only rows of the k + 1 smallest ids can be among the best, as one of
    them may be the query's own, and of each id k rows; no more of them are compared.
    """
    order = np.argsort(vector_ids, kind="stable")
    vectors, vector_ids = vectors[order], vector_ids[order]
    _, group = np.unique(vectors, axis=0, return_inverse=True)
    by_group = np.argsort(group.ravel(), kind="stable")
    sorted_group = group.ravel()[by_group]
    sorted_ids, place = vector_ids[by_group], np.arange(len(by_group))
    new_group = np.r_[True, sorted_group[1:] != sorted_group[:-1]]
    new_id = new_group | np.r_[True, sorted_ids[1:] != sorted_ids[:-1]]
    number = np.cumsum(new_id) - 1  # of the id, over all groups
    id_rank = number - number[np.maximum.accumulate(np.where(new_group, place, 0))]
    repeat = place - np.maximum.accumulate(np.where(new_id, place, 0))
    chosen = np.sort(by_group[(id_rank <= k) & (repeat < k)])
    vectors, vector_ids = vectors[chosen], vector_ids[chosen]
    turned, asked = rotated(vectors), rotated(queries)
    norms = np.linalg.norm(vectors, axis=1)
    n, d = turned.shape
    cuts = sorted({c for c in (8, 16, 32, 64, 128, 256, 512, 1024, 2048) if c < d} | {d})
    for begin in range(0, len(asked), QUERIES_AT_ONCE):
        q, ids = asked[begin : begin + QUERIES_AT_ONCE], query_ids[begin : begin + QUERIES_AT_ONCE]
        # The k-th distance to some first candidates bounds what can be among the best.
        head = np.maximum(0, 2 - 2 * q @ turned[: 64 * (k + 1)].T)
        head[ids[:, None] == vector_ids[None, : 64 * (k + 1)]] = np.inf
        bound = np.sort(head, axis=1)[:, k - 1] if n >= k else np.full(len(q), np.inf)
        i, j = np.divmod(np.arange(len(q) * n), n)
        part, low = np.zeros(len(i)), 0
        for high in cuts:
            if len(i) == len(q) * n:  # nothing given up yet: whole matrices
                a, b = q[:, low:high], turned[:, low:high]
                square = (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None] - 2 * a @ b.T
                part = part + square.ravel()
            else:
                part = part + ((q[i, low:high] - turned[j, low:high]) ** 2).sum(axis=1)
            low = high
            loose = 1.0 if high == d else (high / d) * (1 + SIGNIFICANCE / high**0.5) ** 2
            stay = part <= bound[i] * loose + SLACK
            if not stay.all():
                i, j, part = i[stay], j[stay], part[stay]
        own = ids[i] != vector_ids[j]
        i, j = i[own], j[own]
        original = queries[begin : begin + QUERIES_AT_ONCE]
        score = np.empty(len(i))
        for at in range(0, len(i), 65536):
            a, b = i[at : at + 65536], j[at : at + 65536]
            dot = (original[a] * vectors[b]).sum(axis=1)
            score[at : at + 65536] = dot / (np.linalg.norm(original, axis=1)[a] * norms[b])
        best = np.lexsort((vector_ids[j], -score, i))
        i, j, score = i[best], j[best], score[best]
        starts = np.flatnonzero(np.r_[True, i[1:] != i[:-1]]) if len(i) else np.zeros(0, int)
        rank = np.arange(len(i)) - np.repeat(starts, np.diff(np.r_[starts, len(i)]))
        top = rank < k
        yield ids[i[top]], vector_ids[j[top]], score[top]


def nearest_neighbours(
    df: DataFrame,
    is_query: Column,
    *,
    id: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    probes: int | None = None,
) -> DataFrame:
    """``(query_id, rank, id, score)``: the k nearest rows found for each query.

    ``is_query`` is a condition on the id column; ids are integers. The score is the
    cosine of the original vectors in double precision, ties go to the smaller id.
    Rows with the id of the query are no candidates. If fewer than k rows take part,
    all of them come. Rows with a null id and vectors that are null, zero, or hold
    null or non-finite components take no part (see :func:`usable_vectors`); a query
    id that is repeated asks once, with the least of its vectors; repeated candidates are
    candidates each. A vector has its neighbours among those of its own dimension; each
    dimension is a search of its own, of which a table is expected to need few. An empty
    table gives no rows; other columns are left out. ``probes`` overrides the number
    of lists per query.

    A list of many rows is cut into pieces and many queries of one list into blocks,
    which meet pairwise, so no task gets a whole list, however often a row is repeated.
    """
    rows = usable_vectors(df, id, vector)
    asked = rows.withColumnRenamed("_id", id).filter(is_query).withColumnRenamed(id, "_id")
    asked = asked.groupBy(F.col("_id").cast("long").alias("_id")).agg(F.min("_v").alias("_v"))
    size = F.size("_v")
    dimensions = sorted(r["d"] for r in rows.select(size.alias("d")).distinct().collect())
    # An empty table is searched too, for a result of the same columns.
    parts = [
        _search(rows.filter(size == d), asked.filter(size == d), d, k, probes) for d in dimensions or [0]
    ]
    found = functools.reduce(DataFrame.unionByName, parts)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "_found")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("_found").alias(id), "score")


def _search(rows: DataFrame, asked: DataFrame, dimension: int, k: int, probes: int | None) -> DataFrame:
    """``(query_id, _found, score)``: from each piece of a list the k best of each query.

    ``rows`` and ``asked`` hold ``(_id, _v)`` of one dimension, ``asked`` each id once.
    """
    lists = fit_lists(rows, dimension, k)
    number = len(lists.centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            owner = lists.nearest(lists.rotated(_matrix(batch.column(1), dimension)), 1)[:, 0]
            turn = np.arange(seen, seen + batch.num_rows)
            seen += batch.num_rows
            columns = [batch.column(0).cast(pa.int64()), batch.column(1), pa.array(owner.astype(np.int32)), pa.array(turn)]
            yield pa.RecordBatch.from_arrays(columns, ["_id", "_v", "_list", "_turn"])

    index = kept(rows.mapInArrow(assign, "_id long, _v array<double>, _list int, _turn long"), "ann-index")
    per_list = index.groupBy("_list").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("_id").alias("ids"))
    lists_of = {r["_list"]: r for r in per_list.collect()}  # at most MOST_LISTS
    sizes = {i: r["n"] for i, r in lists_of.items()}
    # Rows besides the query's own that a list holds at least.
    others = np.array([max(0, int(0.8 * lists_of[i]["ids"]) - 1) if i in lists_of else 0 for i in range(number)])
    probed = min(number, probes or lists.probes)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                near = lists.nearest(lists.rotated(_matrix(batch.column(1), dimension)), number)
                # At least so many lists, and enough for k rows besides the query's own.
                held = np.cumsum(others[near], axis=1)
                enough = np.maximum(probed, (held < k).sum(axis=1) + 1)
                row, rank = np.nonzero(np.arange(number)[None] < enough[:, None])
                taken, number_of = pa.array(row), pa.array(near[row, rank].astype(np.int32))
                columns = [batch.column(0).take(taken), batch.column(1).take(taken), number_of]
                yield pa.RecordBatch.from_arrays(columns, ["_id", "_v", "_list"])

    asked = kept(asked.mapInArrow(probe, "_id long, _v array<double>, _list int"), "ann-queries")
    wanted = {r["_list"]: r["n"] for r in asked.groupBy("_list").agg(F.count(F.lit(1)).alias("n")).collect()}

    def parts(counts: dict[int, int], most: int) -> Column:
        """How many parts each list is cut into; at most MOST_LISTS entries."""
        cut = [(F.lit(l), F.lit(-(-n // most))) for l, n in sorted(counts.items()) if n > most]
        table = F.create_map(*[x for pair in cut for x in pair]) if cut else None
        return F.lit(1) if table is None else F.coalesce(table[F.col("_list")], F.lit(1))

    pieces, blocks = parts(sizes, PIECE), parts(wanted, QUERY_BLOCK)
    cells = ["_list", "_piece", "_block"]
    left = asked.withColumn("_block", F.pmod(F.xxhash64("_id"), blocks).cast("int"))
    left = left.withColumn("_piece", F.explode(F.sequence(F.lit(0), (pieces - 1).cast("int"))))
    right = index.withColumn("_piece", F.pmod("_turn", pieces).cast("int")).drop("_turn")
    right = right.withColumn("_block", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))))

    def scan(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        found = []
        if len(queries) and len(vectors):
            found = list(
                scan_list(
                    _matrix(queries.column("_v"), dimension),
                    queries.column("_id").to_numpy(),
                    _matrix(vectors.column("_v"), dimension),
                    vectors.column("_id").to_numpy(),
                    lists.rotated,
                    k,
                )
            )
        columns = [np.concatenate([f[c] for f in found]) if found else [] for c in range(3)]
        kinds = [pa.int64(), pa.int64(), pa.float64()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], ["query_id", "_found", "score"])

    both = left.groupBy(*cells).cogroup(right.groupBy(*cells))
    return both.applyInArrow(scan, "query_id long, _found long, score double")
