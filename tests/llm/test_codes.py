"""Orchard's search and whole codebooks against brute force."""

import hashlib
import math

import pytest

pytest.importorskip("weft.llm")

import numpy as np  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from weft.llm import codes  # noqa: E402
from weft.llm.codes import (  # noqa: E402
    Neighbours,
    compress_vectors,
    decode_codes,
    encode_codes,
    integer_vectors,
    train_codes,
)

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_nearest(books, vectors):
    parts = vectors.reshape(len(vectors), len(books), -1)
    squares = np.stack([((parts[:, p, None] - books[p][None]) ** 2).sum(axis=2) for p in range(len(books))], axis=1)
    return squares.argmin(axis=2), squares.min(axis=2)


def plain(rows, entries=256, rounds=4, parts=4):
    """{row number: (code, error)} and the final entries, one plain step at a time."""
    kept = {
        i: [math.floor(1024 * float(np.float32(x))) for x in r[1]]
        for i, r in enumerate(rows)
        if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])
    }
    cut = lambda v: [v[p * len(v) // parts : (p + 1) * len(v) // parts] for p in range(parts)]
    first = {}
    for i, v in kept.items():
        if rows[i][0] is not None:
            first[rows[i][0]] = min(first.get(rows[i][0], v), v)
    chosen = [cut(first[k]) for k in sorted(first)[:entries]]
    books = [[c[p] for c in chosen] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def nearest(v):
        return [min((far(x, e), j) for j, e in enumerate(books[p])) for p, x in enumerate(cut(v))]

    for _ in range(rounds):
        found = {i: nearest(v) for i, v in kept.items()}
        new = [list(b) for b in books]
        for p in range(parts):
            for j in range(len(books[p])):
                mine = [cut(kept[i])[p] for i in kept if found[i][p][1] == j]
                if mine:
                    new[p][j] = [sum(xs) // len(mine) for xs in zip(*mine)]
        books = new
    found = {i: nearest(v) for i, v in kept.items()}
    return {i: (bytes(j for _, j in f), sum(d for d, _ in f)) for i, f in found.items()}, books


@pytest.mark.parametrize("spread", [2, 30, 5000])
def test_search_finds_the_nearest_entry_and_the_lowest_of_ties(spread):
    rng = np.random.default_rng(spread)
    for width, count in ((1, 7), (3, 40), (16, 256)):
        books = rng.integers(-spread, spread, (4, count, width))
        books[:, count // 2] = books[:, count // 3]  # equal entries
        vectors = rng.integers(-spread, spread, (300, 4 * width))
        vectors[:50] = books[:, rng.integers(0, count, 50)].transpose(1, 0, 2).reshape(50, -1)
        entry, square = Neighbours(books).nearest(vectors)
        want, least = brute_nearest(books, vectors)
        assert (entry == want).all() and (square == least).all()


def test_search_ends_early_among_clusters(monkeypatch):
    """Entries of far clusters are never compared."""
    rng = np.random.default_rng(1)
    centres = np.repeat(np.arange(16) * 10_000, 16)
    books = (centres[:, None] + rng.integers(-50, 50, (256, 16)))[None]
    vectors = centres[rng.integers(0, 256, 200)][:, None] + rng.integers(-50, 50, (200, 16))
    near = Neighbours(books)
    compared, squares = [], codes._squares
    monkeypatch.setattr(codes, "_squares", lambda a, b: compared.append(len(a)) or squares(a, b))
    entry, _ = near.nearest(vectors)
    assert (entry == brute_nearest(books, vectors)[0]).all()
    assert sum(compared) < 200 * 256 / 4


def test_codes_are_those_of_the_plain_rounds(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(120, 8)).astype(np.float32)
    vectors[40:60] = vectors[:20]  # repeated vectors
    rows = [(int(i) * 3 % 127, [float(x) for x in v], None if i % 7 == 0 else i % 3) for i, v in enumerate(vectors)]
    rows += [rows[5], rows[5]]  # repeated rows
    rows += [(0, [9.0] * 8, 1), (-1, None, 1), (-2, [1.0, None] * 4, 1), (-3, [math.nan] * 8, 1), (-4, [math.inf] * 8, 1)]
    rows += [(None, [0.5] * 8, None)]
    want, books = plain(rows, entries=16)
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], SCHEMA + ", error long").repartition(5)
    got, found = compress_vectors(df.withColumnRenamed("error", "n"), entries=16)
    assert got.columns == ["vec_id", "embedding", "label", "n", "code", "error"]
    assert {r["n"]: (bytes(r["code"]), r["error"]) for r in got.collect()} == want
    assert found.books[8].tolist() == books
    text = ",".join(str(x) for part in books for entry in part for x in entry)
    assert found.digest() == hashlib.sha256(text.encode()).hexdigest()
    clash, _ = compress_vectors(df, entries=16, keep=["vec_id", "error", "label"])
    assert clash.columns == ["vec_id", "label", "code", "error"]
    near = decode_codes(got, found, 8).select("embedding", "approximation").first()
    assert np.abs(np.subtract(*near)).max() < 3


def test_dimensions_of_their_own_and_unequal_parts(spark):
    rows = [(1, [1.0] * 4, 0), (2, [2.0] * 8, 0), (3, [3.0] * 8, 0), (4, [1.0] * 5, 0), (5, [], 0)]
    got, books = compress_vectors(spark.createDataFrame(rows, SCHEMA))
    found = {r["vec_id"]: (r["code"] and bytes(r["code"]).hex(), r["error"]) for r in got.collect()}
    assert found == {1: ("0" * 8, 0), 2: ("0" * 8, 0), 3: ("01" * 4, 0), 4: (None, None), 5: ("0" * 8, 0)}
    assert set(books.books) == {0, 4, 8}


def test_empty_table_and_large_components(spark):
    got, books = compress_vectors(spark.createDataFrame([], SCHEMA))
    assert got.count() == 0 and books.books == {} and train_codes(integer_vectors(spark.createDataFrame([], SCHEMA))).books == {}
    df = spark.createDataFrame([(1, [2.0**17] * 4, 0), (2, [-(2.0**17)] * 4, 0)], SCHEMA)
    got, _ = compress_vectors(df, entries=1)
    # The mean lies in the middle, and the distances are exact.
    assert [r["error"] for r in got.collect()] == [4 * 2**54] * 2
    with pytest.raises(Exception, match="too large"):
        integer_vectors(spark.createDataFrame([(1, [2.0**19], 0)], SCHEMA)).collect()


def test_vectors_without_codebook_have_no_code(spark):
    df = integer_vectors(spark.createDataFrame([(1, [1.0] * 4, 0)], SCHEMA))
    books = train_codes(df)
    other = integer_vectors(spark.createDataFrame([(1, [1.0] * 8, 0)], SCHEMA)).unionByName(
        spark.createDataFrame([(2, None, 0)], "vec_id long, embedding array<long>, label int")
    )
    assert encode_codes(other, books).filter(F.col("code").isNotNull() | F.col("error").isNotNull()).isEmpty()
