"""The registered queries of this folder: each applies its operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm.ann import nearest_neighbours
from weft.llm.bpe import decode_bpe, encode_bpe
from weft.llm.chat import chat_digests, format_chats
from weft.llm.codes import ENTRIES, PARTS, ROUNDS, SCALE, compress_vectors
from weft.llm.common import id_remainder, kept
from weft.llm.exact import exact_groups
from weft.llm.langid import identify_language, train_langid
from weft.llm.merkle import fold, leaf_digest, merkle_manifest, siblings_text
from weft.llm.packing import pack_tokens
from weft.llm.quality import score_quality, train_quality
from weft.llm.secrets import KINDS, learn_formats, scan_secrets
from weft.llm.simhash import near_components
from weft.llm.token_counts import recount_tokens
from weft.llm.warc import read_warc, write_warc
from weft.sources.scratch import scratch_path
from weft.sources.tables import load_table, widened

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
QUALITY_BOUND = 0.3
NUMBER, NUMBER_MASK = r"[0-9]+", "0"


def all_documents(spark: SparkSession, directory: str) -> DataFrame:
    """The table; spread over the cores where it comes as one or a few small files."""
    return widened(load_table(spark, directory, "documents"))


def query(oracle: str | None = None):
    """Register the function under its own name."""

    def add(body):
        QUERIES[body.__name__] = body
        if oracle:
            ORACLES[body.__name__] = oracle
        return body

    return add


@query()
def op2_byte_bpe(spark: SparkSession, directory: str) -> DataFrame:
    """Ids of every document and the bytes they decode to, as digests."""
    documents = all_documents(spark, directory)
    encoded = encode_bpe(documents, BYTE_RANKS, public_tokenizers.PATTERN, keep=["doc_id"])
    both = decode_bpe(encoded, BYTE_RANKS)
    return both.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def packed(documents: DataFrame) -> DataFrame:
    pieces = pack_tokens(documents, WORD_TOKENIZER, END_ID)
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@query()
def op9_packing(spark: SparkSession, directory: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens."""
    return packed(all_documents(spark, directory))


def trained_quality(spark: SparkSession, directory: str):
    """Trees learned from labels outside the held-out fifth."""
    documents, labels = (load_table(spark, directory, t) for t in ("documents", "labels"))
    return train_quality(documents, labels.filter(id_remainder("doc_id", 5) != 0))


@query()
def op1_quality(spark: SparkSession, directory: str) -> DataFrame:
    """Quality score of every document."""
    documents = all_documents(spark, directory)
    scored = score_quality(documents, trained_quality(spark, directory), keep=["doc_id"])
    held_out = F.coalesce(id_remainder("doc_id", 5) == 0, F.lit(False))
    predicted = (F.col("score") >= QUALITY_BOUND).cast("int")
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted")
    )


@query()
def op5_secrets(spark: SparkSession, directory: str) -> DataFrame:
    """Secrets in every document: by patterns, and by formats learned from those."""
    documents = all_documents(spark, directory)
    scanned = scan_secrets(documents, learn_formats(documents), keep=["doc_id"])

    def joined(spans):
        marks = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(marks, ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS))
    counts = [
        F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
        for kind in KINDS
    ]
    return scanned.select(
        "doc_id",
        *counts,
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


@query()
def op8_language(spark: SparkSession, directory: str) -> DataFrame:
    """Language of every document, learned from two thirds of them."""
    documents = all_documents(spark, directory)
    network = train_langid(documents, id_remainder("doc_id", 3) != 1)
    found = identify_language(documents, network, keep=["doc_id"])
    held_out = F.coalesce(id_remainder("doc_id", 3) == 1, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query()
def op4_simhash(spark: SparkSession, directory: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    components = near_components(all_documents(spark, directory))
    bits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return components.select("doc_id", bits.alias("fingerprint"), "component_id")


@query(
    oracle=r"""
    WITH texts AS (
        SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
        FROM documents
    )
    SELECT
        doc_id,
        min(doc_id) OVER (PARTITION BY body) AS keep_id,
        count(*) OVER (PARTITION BY body) AS group_size,
        doc_id = min(doc_id) OVER (PARTITION BY body) AS kept,
        sha256(body) AS text_sha256
    FROM texts
    """
)
def op7_exact_dedup(spark: SparkSession, directory: str) -> DataFrame:
    """For every document the one that stays of its group of equal texts."""
    return exact_groups(load_table(spark, directory, "documents"))


@query()
def op6_neighbours(spark: SparkSession, directory: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    embeddings = load_table(spark, directory, "embeddings")
    return nearest_neighbours(embeddings, F.col("vec_id") % 50 == 0)


@query(
    oracle=r"""
    WITH bodies AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
    digests AS (
        SELECT
            page_id,
            strlen(body)::BIGINT AS payload_bytes,
            unhex(sha1(body)) AS raw,
            min(page_id) OVER (PARTITION BY body) AS lowest
        FROM bodies
    ),
    letters AS (
        SELECT page_id, string_agg(
            substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', bits::INT + 1, 1), '' ORDER BY spot
        ) AS payload_digest
        FROM (
            SELECT page_id, spot, ('0b' || substr(digits, 5 * spot + 1, 5))::INT AS bits
            FROM (SELECT page_id, raw::BIT::VARCHAR AS digits FROM digests), range(32) AS places(spot)
        )
        GROUP BY page_id
    )
    SELECT
        page_id,
        payload_bytes,
        payload_digest,
        CASE WHEN page_id = lowest THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN page_id <> lowest THEN lowest END AS refers_to
    FROM digests JOIN letters USING (page_id)
    """
)
def op10_warc(spark: SparkSession, directory: str) -> DataFrame:
    """Every page as a WARC record, read back from the archives."""
    folder = scratch_path(spark, "warc")
    index = write_warc(load_table(spark, directory, "pages"), folder)
    return read_warc(index, folder, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query()
def op3_token_counts(spark: SparkSession, directory: str) -> DataFrame:
    """Tokens of every document before and after an edit of each of its numbers."""
    documents = all_documents(spark, directory)
    rules = BYTE_RANKS, public_tokenizers.PATTERN
    again = recount_tokens(documents, *rules, (NUMBER, NUMBER_MASK), keep=["doc_id"])
    return again.select(
        "doc_id",
        "n_tokens",
        "n_edits",
        "edited_tokens",
        "n_encoded",
        F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
    )


@query(
    oracle=r"""
    WITH RECURSIVE given AS (
        SELECT *, xor(crc, 4294967295::UBIGINT) % 7 = 0 AS tampers
        FROM (
            SELECT *, list_reduce(
                [4294967295::UBIGINT] || list_transform(
                    string_split(doc_id::VARCHAR, ''), lambda letter: ascii(letter)::UBIGINT
                ),
                lambda crc, byte: list_reduce(
                    [xor(crc, byte)] || [0, 1, 2, 3, 4, 5, 6, 7]::UBIGINT[],
                    lambda c, bit: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END
                )
            ) AS crc
            FROM documents
        )
    ),
    hashed AS (
        SELECT
            doc_id,
            lang,
            sha256(head || n || tail) AS leaf,
            sha256(head || CASE WHEN tampers THEN more ELSE n END || tail) AS brought
        FROM (
            SELECT
                doc_id,
                lang,
                tampers,
                coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
                || coalesce(strlen(source) || ':' || source, '-')
                || coalesce(strlen(lang) || ':' || lang, '-') AS head,
                coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS n,
                coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') AS more,
                coalesce(strlen(text) || ':' || text, '-') AS tail
            FROM given
        )
    ),
    leaves AS (
        SELECT
            *,
            row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
            count(*) OVER (PARTITION BY lang) AS n
        FROM hashed
    ),
    nodes AS (
        SELECT 0 AS depth, lang, i, n, leaf AS h FROM leaves
        UNION ALL
        SELECT depth + 1, lang, i // 2, (max(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY i))
        FROM nodes
        WHERE n > 1
        GROUP BY depth, lang, i // 2
    ),
    tops AS (
        SELECT
            lang,
            h AS subroot,
            row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i,
            count(*) OVER () AS n
        FROM nodes
        WHERE n = 1
    ),
    upper AS (
        SELECT 0 AS depth, i, n, subroot AS h FROM tops
        UNION ALL
        SELECT depth + 1, i // 2, (max(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY i))
        FROM upper
        WHERE n > 1
        GROUP BY depth, i // 2
    ),
    climb AS (
        SELECT doc_id, leaf, lang, 0 AS depth, i, n, brought AS folded, '' AS proof FROM leaves
        UNION ALL
        SELECT
            c.doc_id,
            c.leaf,
            c.lang,
            c.depth + 1,
            c.i // 2,
            (c.n + 1) // 2,
            sha256(CASE WHEN c.i % 2 = 1 THEN s.h || c.folded ELSE c.folded || coalesce(s.h, '') END),
            c.proof || coalesce(s.h, '')
        FROM climb AS c
        LEFT JOIN nodes AS s
        ON s.depth = c.depth AND s.lang IS NOT DISTINCT FROM c.lang AND s.i = xor(c.i, 1)
        WHERE c.n > 1
    ),
    over AS (
        SELECT c.doc_id, c.leaf, t.subroot, 0 AS depth, t.i, t.n, c.folded, c.proof
        FROM climb AS c
        JOIN tops AS t ON t.lang IS NOT DISTINCT FROM c.lang
        WHERE c.n = 1
        UNION ALL
        SELECT
            c.doc_id,
            c.leaf,
            c.subroot,
            c.depth + 1,
            c.i // 2,
            (c.n + 1) // 2,
            sha256(CASE WHEN c.i % 2 = 1 THEN s.h || c.folded ELSE c.folded || coalesce(s.h, '') END),
            c.proof || coalesce(s.h, '')
        FROM over AS c
        LEFT JOIN upper AS s ON s.depth = c.depth AND s.i = xor(c.i, 1)
        WHERE c.n > 1
    )
    SELECT
        doc_id,
        leaf,
        subroot,
        root,
        sha256(proof) AS proof_sha256,
        folded AS folded_root,
        folded = root AS verified
    FROM over, (SELECT h AS root FROM upper WHERE n = 1) AS the_root
    WHERE n = 1
    """
)
def op13_merkle(spark: SparkSession, directory: str) -> DataFrame:
    """Leaf, roots and proof of every document, folded again after tampering with some."""
    documents = load_table(spark, directory, "documents")
    more = F.col("n_chars") + F.when(id_remainder("doc_id", 7) == 0, 1).otherwise(0)
    brought = leaf_digest(*map(F.col, ("doc_id", "source", "lang")), more, F.col("text"))
    manifest = merkle_manifest(documents.withColumn("brought", brought), keep=["doc_id", "brought"])
    folded = fold(F.col("brought"), F.col("proof"))
    return manifest.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(siblings_text(F.col("proof")).cast("binary"), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _codes_oracle() -> str:
    """Rounds of assignment and means, each as two common table expressions."""
    near = """near{0} AS MATERIALIZED (
        SELECT
            vec_id,
            part,
            min((list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c))::BIGINT
                * {1} + entry) AS best
        FROM pieces JOIN book{0} USING (part)
        GROUP BY vec_id, part
    )"""
    book = """book{2} AS MATERIALIZED (
        SELECT b.part, b.entry, coalesce(m.c, b.c) AS c
        FROM book{0} AS b
        LEFT JOIN (
            SELECT part, entry, list(floor(total / n) ORDER BY place) AS c
            FROM (
                SELECT p.part, best % {1} AS entry, place, sum(x[place + 1]) AS total, count(*) AS n
                FROM pieces AS p JOIN near{0} USING (vec_id, part), range(width) AS places(place)
                GROUP BY 1, 2, 3
            )
            GROUP BY part, entry
        ) AS m USING (part, entry)
    )"""
    rounds = [t.format(r, ENTRIES, r + 1) for r in range(ROUNDS) for t in (near, book)]
    return f"""
    WITH sound AS (
        SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
        FROM embeddings
        WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    ),
    pieces AS MATERIALIZED (
        SELECT
            vec_id,
            part,
            len(v) // {PARTS} AS width,
            v[part * (len(v) // {PARTS}) + 1 : (part + 1) * (len(v) // {PARTS})] AS x
        FROM sound, range({PARTS}) AS parts(part)
    ),
    book0 AS MATERIALIZED (
        SELECT part, rank - 1 AS entry, x AS c
        FROM pieces JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS rank FROM sound) USING (vec_id)
        WHERE rank <= {ENTRIES}
    ),
    {", ".join(rounds)},
    {near.format(ROUNDS, ENTRIES)},
    coded AS (
        SELECT
            vec_id,
            lower(string_agg(printf('%02x', best % {ENTRIES}), '' ORDER BY part)) AS code,
            sum(best // {ENTRIES})::BIGINT AS error
        FROM near{ROUNDS}
        GROUP BY vec_id
    ),
    books AS (
        SELECT sha256(string_agg(entry_text, ',' ORDER BY part, entry)) AS codebooks_sha256
        FROM (
            SELECT part, entry, array_to_string(list_transform(c, lambda x: x::BIGINT), ',') AS entry_text
            FROM book{ROUNDS}
        )
    )
    SELECT
        vec_id,
        code,
        error,
        (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
        codebooks_sha256
    FROM coded JOIN sound USING (vec_id), books
    """


@query(oracle=_codes_oracle())
def op11_vector_codes(spark: SparkSession, directory: str) -> DataFrame:
    """Codes of all vectors, their errors, and a digest of the codebooks."""
    embeddings = load_table(spark, directory, "embeddings")
    coded, books = compress_vectors(embeddings, keep=["vec_id", "label"])
    coded = kept(coded, "codes")  # read by the totals and by the rows
    totals = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(books.digest()).alias("codebooks_sha256"),
    )


@query()
def op12_chat(spark: SparkSession, directory: str) -> DataFrame:
    """All conversations in windows, and what is read back from them."""
    conversations = load_table(spark, directory, "conversations")
    said = "</s>[INST] ok [/INST]"
    tricky = [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    more = spark.createDataFrame(tricky, "conv_id long, turn long, role string, text string")
    windows = format_chats(conversations.select(more.columns).unionByName(more), WORD_TOKENIZER)
    return chat_digests(kept(windows, "chats"))
