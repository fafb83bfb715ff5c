"""Byte-level BPE, token counts under edits, and packing, against the libraries."""

import random
import struct
import zlib

import pytest

pytest.importorskip("weft.llm")

import numpy as np  # noqa: E402
import public_tokenizers  # noqa: E402
import tiktoken  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from weft.llm.bpe import Encoder, decode_bpe, encode_bpe, read_ranks  # noqa: E402
from weft.llm.common import Memo  # noqa: E402
from weft.llm.packing import WordEncoder, pack_tokens, sequences  # noqa: E402
from weft.llm.token_counts import Counter, Tree, count_tokens, edited, recount_tokens  # noqa: E402

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PATTERN = public_tokenizers.PATTERN
BITS = (
    "a aa The don't 's ' \t \n \x20 \x20\x20 1 22 !! é É 的 🙂 \x85 　 \x1c 'LL ß ª _ ` ﬁ İ Σ "
    "word ing <|endoftext|> é H̱ × ``"
).split(" ")
EDGE = [
    (1, None),
    (2, ""),
    (None, "a null id"),
    (4, "same"),
    (4, "same"),
    (5, " \n\t "),
    (6, "x" * 300_000),
    (7, "tabs\tand  two\r\nlines\x85 of　 kinds "),
]


@pytest.fixture(scope="module")
def bpe():
    ranks = read_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def word_bpe():
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def mixed(rng, most=40):
    bits = [*BITS, " ", " ", "\n"]
    return "".join(rng.choice(bits) for _ in range(rng.randint(0, most)))


def unpacked(data):
    return list(struct.unpack(f"<{len(data) // 4}I", data))


def test_bpe_of_random_texts(bpe):
    encoder, rng = Encoder(RANKS, PATTERN), random.Random(1)
    for _ in range(3000):
        letters = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzetaoin") for _ in range(rng.randint(0, 60)))
        for text in (mixed(rng), letters):
            assert unpacked(encoder.encode(text)) == bpe.encode_ordinary(text)
    assert unpacked(encoder.encode("ab" * 50_000)) == bpe.encode_ordinary("ab" * 50_000)


def test_bpe_of_documents_and_edge_rows(spark, bpe):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    edge = spark.createDataFrame(EDGE, documents.schema)
    clash = documents.union(edge).withColumn("N_Tokens", F.lit("x")).withColumn("_input0", F.lit(1))
    encoded = encode_bpe(clash, RANKS, PATTERN)
    assert encoded.columns == ["doc_id", "text", "_input0", "ids", "n_tokens"]
    rows = decode_bpe(encoded, RANKS).collect()
    assert len(rows) == documents.count() + len(EDGE)
    for row in rows:
        text = row["text"] or ""
        assert unpacked(row["ids"]) == bpe.encode_ordinary(text)
        assert row["n_tokens"] == len(row["ids"]) // 4
        assert bytes(row["decoded"]) == text.encode()
    assert encode_bpe(documents.limit(0), RANKS, PATTERN).count() == 0


def test_memo_keeps_a_bounded_number():
    memo = Memo(lambda x: x * x, 10)
    assert [memo[i % 37] for i in range(500)] == [(i % 37) ** 2 for i in range(500)]
    assert len(memo) <= 10 and len(memo.old) <= 10


def test_edits_of_random_texts(bpe):
    counter, rng = Counter(RANKS, PATTERN), random.Random(2)
    for _ in range(3000):
        text = mixed(rng, 80)
        edits = []
        for _ in range(rng.randint(0, 6)):
            start = rng.randint(-2, len(text) + 2)
            edits.append((start, start + rng.randint(0, 8), mixed(rng, 3)))
        want, at = [], 0
        for start, end, new in sorted(edits, key=lambda e: e[:2]):
            start, end = max(0, min(start, len(text))), max(0, min(end, len(text)))
            if start >= at or not want:
                want += [text[at:start], new]
                at = end
        want = "".join([*want, text[at:]])
        leaves = counter.leaves(text) if text else np.zeros((0, 2), np.int32)
        tree = Tree.load(Tree(leaves).dump())
        new, tree, _ = edited(text, tree, edits, counter)
        assert new == want
        assert tree.tokens == len(bpe.encode_ordinary(want))
        again = counter.leaves(want) if want else np.zeros((0, 2), np.int32)
        assert np.array_equal(np.concatenate(tree.blocks), again)
        assert tree.sums[1, 0] == len(want)


def test_an_edit_encodes_its_surroundings_only(bpe):
    counter = Counter(RANKS, PATTERN)
    text = "many words stand here, " * 5000
    tree = Tree(counter.leaves(text))
    new, tree, encoded = edited(text, tree, [(50_000, 50_003, "xyz")], counter)
    assert encoded < 10
    new, tree, encoded = edited(new, tree, [(10, 10, "inserted words " * 3000)], counter)
    assert tree.tokens == len(bpe.encode_ordinary(new))
    assert max(map(len, tree.blocks)) <= 512


def test_counts_of_documents_and_edge_rows(spark, bpe):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = documents.union(spark.createDataFrame(EDGE, documents.schema)).withColumn("tree", F.lit(1))
    counted = count_tokens(rows, RANKS, PATTERN)
    again = recount_tokens(counted, RANKS, PATTERN, (r"[0-9]+", "#"))
    twice = recount_tokens(
        again.select("doc_id", F.col("edited_text").alias("text"), F.col("edited_tree").alias("tree"))
        .withColumn("edits", F.expr("array(struct(1 as start, 4 as end, cast(null as string) as text))")),
        RANKS,
        PATTERN,
        "edits",
    )
    at_once = recount_tokens(rows.drop("tree"), RANKS, PATTERN, (r"[0-9]+", "#"))
    columns = sorted(at_once.columns)
    found, want = at_once.select(columns).collect(), again.select(columns).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, want))
    for row in again.collect():
        assert row["n_tokens"] == len(bpe.encode_ordinary(row["text"] or ""))
        assert row["edited_tokens"] == len(bpe.encode_ordinary(row["edited_text"]))
        assert (row["n_encoded"] > 0) == (row["n_edits"] > 0)
    for row in twice.collect():
        assert row["edited_text"] == row["text"][:1] + row["text"][4:]
        assert row["edited_tokens"] == len(bpe.encode_ordinary(row["edited_text"]))


def test_word_ids_of_random_texts(word_bpe):
    encoder, rng = WordEncoder(WORDS), random.Random(3)
    assert encoder.plain
    for _ in range(3000):
        text = mixed(rng)
        assert unpacked(encoder.encode(text)) == word_bpe(text)


@pytest.mark.parametrize("window", [16, 4096])
def test_packing(spark, word_bpe, window):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    edge = spark.createDataFrame(EDGE, documents.schema)
    rows = documents.filter("doc_id >= 10").union(edge).withColumn("start", F.lit(9)).repartition(5, "text")
    pieces = pack_tokens(rows, WORDS, 2, window=window).collect()
    want = sorted(
        ((r["doc_id"], [*word_bpe(r["text"] or ""), 2]) for r in rows.collect()), key=repr
    )
    stream, held = [], {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["sequence_id"] * window + p["offset"] == len(stream)
        ids = unpacked(p["ids"])
        assert len(ids) == p["length"] > 0 and p["offset"] + p["length"] <= window
        if p["start"] == 0:
            held.setdefault(p["doc_id"], []).append([])
        assert p["start"] == len(held[p["doc_id"]][-1])
        held[p["doc_id"]][-1] += ids
        if len(held[p["doc_id"]][-1]) == p["doc_tokens"]:
            assert ids[-1] == 2
        stream += ids
    found = sorted(((k, ids) for k, many in held.items() for ids in many), key=repr)
    assert found == want
    if window == 4096:
        whole = sequences(pack_tokens(rows, WORDS, 2), 0).orderBy("sequence_id").collect()
        joined = [i for s in whole for i in unpacked(s["ids"])[: s["n_tokens"]]]
        assert len(joined) == len(stream)
        assert all(len(s["ids"]) == 4 * window for s in whole[:-1])
    assert pack_tokens(rows.limit(0), WORDS, 2).count() == 0


def test_short_sequences_are_padded(spark):
    one = spark.createDataFrame([(0, 0, 3, b"abcdefghijkl"), (1, 0, 4, b"abcdefghijklmnop")], "sequence_id long, offset long, length long, ids binary")
    got = {r["sequence_id"]: bytes(r["ids"]) for r in sequences(one, 7, 8).collect()}
    assert got == {0: b"abcdefghijkl" + struct.pack("<5I", *[7] * 5), 1: b"abcdefghijklmnop"}


def test_packing_query(spark):
    from weft.llm.queries import op9_packing

    row = op9_packing(spark, "/root/testdata/sf0.001").filter("doc_id = 3 and start = 0").first()
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("doc_id = 3").first()["text"]
    ids = [*Tokenizer.from_file(WORDS).encode(text, add_special_tokens=False).ids, 2]
    part = struct.pack(f"<{row['length']}I", *ids[: row["length"]])
    assert row["ids_crc32"] == zlib.crc32(part)
    assert row["doc_tokens"] == len(ids)


@pytest.mark.parametrize("pattern", [r"\S+\s*|\s+", r"\p{Lu}\p{Ll}*|\p{Ll}+|[^\p{L}]+", r"(?:.|\n){1,3}", r"(\w+)|(\W+)"])
def test_any_pattern_gives_the_ids_of_the_library(spark, pattern):
    ranks = read_ranks(RANKS)
    plain = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(3)
    texts = [mixed(rng) for _ in range(80)] + ["Some evenly spaced Words here\nand there", "aB cD eF", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {r["doc_id"]: unpacked(r["ids"]) for r in encode_bpe(df, RANKS, pattern).collect()}
    assert found == {i: plain.encode_ordinary(t) for i, t in enumerate(texts)}
    again = recount_tokens(df, RANKS, pattern, ("[aeT ]", "X.")).collect()
    for r in again:
        assert r["n_tokens"] == len(plain.encode_ordinary(r["text"]))
        assert r["edited_tokens"] == len(plain.encode_ordinary(r["edited_text"]))


def test_registered_queries_equal_the_libraries(spark, bpe):
    """The digests of op2 and op3 themselves, over a whole table."""
    import hashlib
    import re

    from weft.llm.queries import op2_byte_bpe, op3_token_counts

    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = {r["doc_id"]: r for r in op2_byte_bpe(spark, folder).collect()}
    counts = {r["doc_id"]: r for r in op3_token_counts(spark, folder).collect()}
    assert set(found) == set(counts) == set(texts)
    for i, text in texts.items():
        ids = bpe.encode_ordinary(text)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        assert found[i]["n_tokens"] == counts[i]["n_tokens"] == len(ids)
        assert found[i]["ids_sha256"] == hashlib.sha256(packed).hexdigest()
        assert found[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        edited_text = re.sub("[0-9]+", "0", text)
        assert counts[i]["edited_tokens"] == len(bpe.encode_ordinary(edited_text))
        assert counts[i]["edited_sha256"] == hashlib.sha256(edited_text.encode()).hexdigest()
