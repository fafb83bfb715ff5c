"""Vectors compressed to codes: product quantisation with Orchard's search.

Components become integers and a vector is cut into equal parts, each with a codebook
of its own. Codebooks are trained by rounds over all rows: a task assigns its vectors
and emits one sum per entry, the sums are added, and the driver divides them. To find
the nearest entry of a part, each entry has the list of all others sorted by their
distance to it. A search walks along the list of the best entry so far, jumps to the
list of a nearer one as soon as it meets one, skips entries already seen, and ends when
the list is beyond twice the current distance: what comes after it cannot be nearer.
All arithmetic is in whole numbers, so results do not depend on the partitioning.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weft.llm.common import kept, map_rows

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
LARGEST = 1 << 28  # of a scaled component; squared distances then fit a long
STRIDE = 16  # entries of a neighbour list looked at in one step
AT_ONCE = 1024  # vectors searched together


class Neighbours:
    """Orchard's search in the codebooks of all parts of one dimension at once."""

    def __init__(self, books: np.ndarray):
        parts, self.count, width = books.shape
        self.parts = parts
        # Doubles hold these whole numbers exactly as long as distances stay below 2 ** 53.
        most = float(np.abs(books).max(initial=0))
        self.most, self.width = most, width
        self.entries = books.reshape(parts * self.count, width)
        gaps = np.stack([_squares(b[:, None], b[None]) for b in books])
        order = np.argsort(gaps, axis=2, kind="stable")
        self.gap = np.take_along_axis(gaps, order, axis=2).reshape(-1, self.count)
        first = (np.arange(parts) * self.count)[:, None, None]
        self.list = (order + first).reshape(-1, self.count)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the nearest entries (ties: the lowest) and squared distances, both
        of shape (vectors, parts)."""
        n = len(vectors)
        asked = vectors.reshape(n * self.parts, self.width)
        entries = self.entries
        if self.width * (self.most + float(np.abs(asked).max(initial=0))) ** 2 < 2**53:
            asked, entries = asked.astype(float), entries.astype(float)
        first = np.tile(np.arange(self.parts) * self.count, n)
        current = first + self._start(asked, n)
        best = _squares(asked, entries[current])
        seen = np.zeros((len(asked), self.count), bool)
        seen[np.arange(len(asked)), current - first] = True
        active, at = np.arange(len(asked)), np.zeros(len(asked), int)
        while len(active):
            place = at[active][:, None] + np.arange(STRIDE)
            inside = place < self.count
            place = np.minimum(place, self.count - 1)
            here = current[active][:, None]
            inside &= self.gap[here, place] <= 4 * best[active][:, None]
            entry = self.list[here, place]
            local = entry - first[active][:, None]
            row, column = np.nonzero(inside & ~seen[active[:, None], local])
            who, met = active[row], entry[row, column]
            seen[who, local[row, column]] = True
            distance = _squares(asked[who], entries[met])
            # The best of each row's entries, the lowest of equally near ones.
            order = np.lexsort((met, distance, row))
            row, who, met, distance = row[order], who[order], met[order], distance[order]
            lead = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else row
            who, met, distance = who[lead], met[lead], distance[lead]
            better = (distance < best[who]) | ((distance == best[who]) & (met < current[who]))
            at[active] += STRIDE
            who = who[better]
            current[who], best[who], at[who] = met[better], distance[better], 0
            jumped = np.zeros(len(asked), bool)
            jumped[who] = True
            # A list goes on if its last look was wholly within twice the distance.
            active = active[jumped[active] | inside[:, -1]]
        return (current - first).reshape(n, -1), best.astype(np.int64).reshape(n, -1)

    def _start(self, asked: np.ndarray, n: int) -> np.ndarray:
        """An entry near in the first component, to begin with."""
        start = np.zeros((n, self.parts), int)
        if self.width:
            heads = self.entries[:, 0].reshape(self.parts, -1)
            for p in range(self.parts):
                order = np.argsort(heads[p], kind="stable")
                place = np.searchsorted(heads[p][order], asked[p :: self.parts, 0])
                start[:, p] = order[np.minimum(place, self.count - 1)]
        return start.ravel()


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    difference = a - b
    return np.einsum("...i,...i->...", difference, difference)


@dataclass
class Codebooks:
    """For each dimension the entries: (parts, entries, components of a part)."""

    parts: int
    books: dict[int, np.ndarray]

    def digest(self) -> str:
        """Hex SHA-256 of all components by dimension, part, entry and place."""
        numbers = [x for d in sorted(self.books) for x in self.books[d].ravel().tolist()]
        return hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()


def integer_vectors(df: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``df`` with each component x of the vectors as the whole number below
    ``scale * x``. Rows whose vector is null or holds null or non-finite components are
    left out; a scaled component of 2 ** 28 or more is an error."""
    column = F.col(f"`{vector}`")
    sound = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = lambda x: x.cast("double") * scale
    whole = lambda x: F.when(F.abs(scaled(x)) < LARGEST, F.floor(scaled(x)).cast("long")).otherwise(
        F.raise_error(F.lit("a component is too large to be coded")).cast("long")
    )
    rows = df.filter(column.isNotNull()).filter(sound)
    return rows.withColumn(vector, F.transform(column, whole))


def _by_dimension(column: pa.Array, parts: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(dimension, rows, vectors)`` of the vectors that have equal parts."""
    sizes = np.diff(column.offsets.to_numpy())
    for d in np.unique(sizes[sizes % parts == 0]).tolist():
        rows = np.flatnonzero(sizes == d)
        values = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
        yield d, rows, values.reshape(len(rows), d).astype(np.int64)


def first_entries(df: DataFrame, id: str, vector: str, parts: int, entries: int) -> Codebooks:
    """Codebooks to begin with: the parts of the vectors of the smallest ids of each
    dimension. Each task keeps no more than ``entries`` ids of a dimension."""
    rows = df.select(F.col(f"`{id}`").alias("_id"), F.col(f"`{vector}`").alias("_v")).filter("_id IS NOT NULL")
    schema = T.StructType([rows.schema["_id"], *T.StructType.fromDDL("_v array<long>, _d int").fields])

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, dict] = {}
        for batch in batches:
            sizes = np.diff(batch.column(1).offsets.to_numpy())
            for d in np.unique(sizes).tolist():
                mine = batch.take(pa.array(np.flatnonzero(sizes == d)))
                held = found.setdefault(d, {})
                order = mine.column(0).to_pylist()
                for i in sorted(range(len(order)), key=order.__getitem__):
                    if len(held) >= entries and order[i] > max(held):
                        break
                    components = mine.column(1)[i].as_py()
                    held[order[i]] = min(held.get(order[i], components), components)
                    if len(held) > entries:
                        del held[max(held)]
        for d, held in found.items():
            columns = [list(held), list(held.values()), [d] * len(held)]
            kinds = [batch.schema.field(0).type, pa.list_(pa.int64()), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], schema.names)

    fit = rows.filter(F.size("_v") % parts == 0).mapInArrow(least, schema)
    one = fit.groupBy("_d", "_id").agg(F.min("_v").alias("_v"))
    rank = F.row_number().over(Window.partitionBy("_d").orderBy("_id"))
    first = one.withColumn("_rank", rank).filter(F.col("_rank") <= entries).select("_d", "_rank", "_v").collect()
    books = {}
    for d in {r["_d"] for r in first}:
        chosen = [r["_v"] for r in sorted((r for r in first if r["_d"] == d), key=lambda r: r["_rank"])]
        table = np.array(chosen, np.int64).reshape(len(chosen), parts, d // parts)
        books[d] = np.ascontiguousarray(table.transpose(1, 0, 2))
    return Codebooks(parts, books)


def improved(df: DataFrame, vector: str, codebooks: Codebooks) -> Codebooks:
    """One round: each entry becomes the whole number below the mean of the parts that
    are nearest to it, component by component; an entry without parts stays."""
    parts, books = codebooks.parts, codebooks.books
    schema = "_d int, _part int, _entry int, _count long, _sums array<long>"

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {d: np.zeros_like(b) for d, b in books.items()}
        counts = {d: np.zeros(b.shape[:2], np.int64) for d, b in books.items()}
        near = {}
        for whole in batches:
            for at in range(0, whole.num_rows, AT_ONCE):
                for d, rows, vectors in _by_dimension(whole.column(0).slice(at, AT_ONCE), parts):
                    if d not in near:
                        near[d] = Neighbours(books[d])
                    entry, _ = near[d].nearest(vectors)
                    place = np.arange(parts)[None], entry
                    np.add.at(sums[d], place, vectors.reshape(len(rows), parts, d // parts))
                    np.add.at(counts[d], place, 1)
        for d in near:
            part, entry = np.nonzero(counts[d])
            columns = [[d] * len(part), part, entry, counts[d][part, entry], list(sums[d][part, entry])]
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["_d", "_part", "_entry", "_count", "_sums"]
            )

    width = max((b.shape[2] for b in books.values()), default=0)
    added = [F.sum(F.get("_sums", F.lit(i))) for i in range(width)]
    partial = df.select(F.col(f"`{vector}`")).mapInArrow(add, schema)
    # One row per entry and task is exchanged, and one per entry reaches the driver.
    totals = partial.groupBy("_d", "_part", "_entry").agg(F.sum("_count"), *added).collect()
    new = {d: b.copy() for d, b in books.items()}
    for d, part, entry, count, *sums in totals:
        size = new[d].shape[2]
        new[d][part, entry] = [s // count for s in sums[:size]]
    return Codebooks(parts, new)


def train_codes(
    df: DataFrame,
    *,
    id: str = "vec_id",
    vector: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> Codebooks:
    """Codebooks of integer vectors (see :func:`integer_vectors`), from all rows.

    They begin with the vectors of the smallest ids, in ascending order, fewer if there
    are fewer; of a repeated id its least vector counts once, a null id is none of
    them. Vectors of each dimension have codebooks of their own, and those that cannot
    be cut into equal parts have none. ``df`` is scanned once per round, so it should be
    a written table. Empty without rows.
    """
    books = first_entries(df, id, vector, parts, entries)
    for _ in range(rounds):
        books = improved(df, vector, books)
    return books


def encode_codes(
    df: DataFrame, codebooks: Codebooks, *, vector: str = "embedding", keep: list[str] | None = None
) -> DataFrame:
    """``df`` with ``code``, one byte per part, and ``error``, the squared distances to
    the entries summed over the parts.

    ``keep`` names the columns that stay (default: all); one named like an output gives
    way to it. A vector that no codebook fits (null, or of another dimension) has null
    for both; repeated rows have equal codes. An empty table gives no rows.
    """
    parts, books = codebooks.parts, codebooks.books
    made: dict[int, Neighbours] = {}

    def run(column: pa.Array) -> list[pa.Array]:
        codes, errors = [None] * len(column), [None] * len(column)
        for d, rows, vectors in _by_dimension(column, parts):
            if d in books:
                if d not in made:
                    made[d] = Neighbours(books[d])
                for at in range(0, len(rows), AT_ONCE):
                    entry, distance = made[d].nearest(vectors[at : at + AT_ONCE])
                    for i, e, s in zip(rows[at : at + AT_ONCE].tolist(), entry, distance.sum(axis=1).tolist()):
                        codes[i], errors[i] = bytes(e.tolist()), s
        for i in np.flatnonzero(~column.is_valid().to_numpy(zero_copy_only=False)).tolist():
            codes[i] = errors[i] = None
        return [pa.array(codes, pa.binary()), pa.array(errors, pa.int64())]

    if any(b.shape[1] > 256 for b in books.values()):
        raise ValueError("a byte numbers at most 256 entries")
    return map_rows(df, [vector], "code binary, error long", run, keep=keep)


def decode_codes(
    df: DataFrame, codebooks: Codebooks, dimension: int, *, code: str = "code", scale: int = SCALE
) -> DataFrame:
    """``df`` with ``approximation``: the vector that a code stands for, null for null."""
    book = codebooks.books[dimension]

    def run(column: pa.Array) -> list[pa.Array]:
        parts = np.arange(book.shape[0])
        vectors = [None if c is None else book[parts, list(c)].ravel() / scale for c in column.to_pylist()]
        return [pa.array(vectors, pa.list_(pa.float64()))]

    return map_rows(df, [code], "approximation array<double>", run)


def compress_vectors(
    df: DataFrame,
    *,
    id: str = "vec_id",
    vector: str = "embedding",
    keep: list[str] | None = None,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, Codebooks]:
    """Codes of all vectors by codebooks trained on them, and the codebooks.

    See :func:`integer_vectors` for the rows that are left out, :func:`train_codes` for
    repeated and null ids, :func:`encode_codes` for the columns. Vectors are written
    once as integers, as training scans them once per round.
    """
    stay = df.columns if keep is None else keep
    mark = "_" * (1 + max(map(len, stay), default=0))  # longer than any name that stays
    given = df.select(
        F.col(f"`{id}`").alias(mark + "id"), F.col(f"`{vector}`").alias(mark + "v"), *[F.col(f"`{c}`") for c in stay]
    )
    rows = kept(integer_vectors(given, mark + "v", scale), "code-vectors")
    books = train_codes(rows, id=mark + "id", vector=mark + "v", parts=parts, entries=entries, rounds=rounds)
    return encode_codes(rows, books, vector=mark + "v", keep=stay), books
