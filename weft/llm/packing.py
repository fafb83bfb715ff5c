"""Packing of token streams: concatenate all documents and cut.

Two passes. The first encodes each document and notes how many tokens its task has
met before it; the totals of the tasks, one row each, are summed up to give every
task its place in the whole stream. The second cuts each document at the borders
of the fixed windows. A piece is a boundary record: which ids of which document
stand where in which sequence. Only the last sequence can be short.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weft.llm.common import Memo, held, kept

WINDOW = 4096
WORDS_KEPT = 250_000
LONGEST_KEPT = 64
#: Of a tokenizer whose words of plain letters need no library call but the model's.
LOWERS = ["NFC", "Replace", "Lowercase"]
CUTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_letters() -> dict[str, str]:
    """Letters below U+0100 as a byte-level model with lower case reads them.

    Printable Latin-1 bytes stand for themselves and others for U+0100 onwards.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    letter = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    plain = [chr(c) for c in range(0x100) if chr(c).isalpha() and chr(c) not in "\xaa\xb5\xba"]
    return {c: "".join(letter[b] for b in c.lower().encode()) for c in plain}


class WordEncoder:
    """Encodes texts, word by word, by a tokenizer that drops white space.

    Blanks and line ends lie inside no token of such a tokenizer, and what it makes
    of a word does not depend on its neighbours, so ids of words are looked up.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # in a text they are ordinary
        if self._ids("a \n b") != self._ids("a") + self._ids("b"):
            raise ValueError("the tokenizer does not drop white space")
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        steps = (rules["normalizer"] or {}).get("normalizers", [])
        cuts = (rules["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        known = [s["type"] for s in steps] == LOWERS and CUTS == cuts[0].get("pattern", {}).get("Regex")
        self.letters = str.maketrans(_byte_letters()) if known else {}
        plain = "".join(map(chr, self.letters))
        self.plain = re.compile(f"([{plain}]+)([!-/:-@\\[-`{{-~]*)").fullmatch if plain else None
        self.model = self.tokenizer.model
        self.words = Memo(self._word, WORDS_KEPT)
        self.marks = Memo(lambda mark: self._bytes(self._ids(mark)), 1000)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    @staticmethod
    def _bytes(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str) -> bytes:
        # Letters, then marks without an apostrophe, are two pieces.
        found = self.plain and self.plain(word)
        if not found or "'" in found[2]:
            return self._bytes(self._ids(word))
        ids = [t.id for t in self.model.tokenize(found[1].translate(self.letters))]
        return self._bytes(ids) + (self.marks[found[2]] if found[2] else b"")

    def encode(self, text: str) -> bytes:
        words = text.replace("\n", " ").split(" ")
        if max(map(len, words)) > LONGEST_KEPT:
            keep, word = self.words, self._word
            return b"".join([keep[w] if len(w) <= LONGEST_KEPT else word(w) for w in words])
        return b"".join(map(self.words.__getitem__, words))


def encode_stream(
    df: DataFrame, path: str, end_id: int, *, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(id, ids, doc_tokens, part, before)``: the ids of each document with
    ``end_id`` behind them, its task, and the tokens of the task before it."""
    schema = T.StructType(
        [df.schema[id], *T.StructType.fromDDL("ids binary, doc_tokens long, part int, before long")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = held(f"words:{path}", lambda: WordEncoder(path)).encode
        part, end, before = TaskContext.get().partitionId(), struct.pack("<I", end_id), 0
        for batch in batches:
            ids = [(encode(t) if t else b"") + end for t in batch.column(1).to_pylist()]
            counts = [len(i) // 4 for i in ids]
            starts = []
            for n in counts:
                starts.append(before)
                before += n
            columns = [
                batch.column(0),
                pa.array(ids, pa.binary()),
                pa.array(counts, pa.int64()),
                pa.array([part] * len(ids), pa.int32()),
                pa.array(starts, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return df.select(f"`{id}`", f"`{text}`").mapInArrow(run, schema)


def pack_tokens(
    df: DataFrame,
    path: str,
    end_id: int,
    *,
    id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """Pieces of all documents in sequences of ``window`` tokens.

    One row per piece: the id column, ``start`` (the document's ids before it),
    ``length``, ``doc_tokens``, ``sequence_id``, ``offset`` and the piece's ``ids``
    (binary, little-endian unsigned 32-bit). ``path`` is a tokenizer file that every
    worker can open.

    Each row is a document of its own, repeated ones and those with a null id too;
    a null or empty text is the end id alone. A text of any length is cut, never
    dropped. An empty table gives no rows; other columns are left out.
    """
    stream = kept(encode_stream(df, path, end_id, id=id, text=text), "tokens")
    totals = stream.groupBy("part").agg(F.sum("doc_tokens").alias("_total"))
    # One row per task of the first pass, so one small window and a bounded broadcast.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_base"))
    placed = stream.join(F.broadcast(bases), "part").withColumn("_at", F.col("_base") + F.col("before"))
    last = F.expr(f"(_at + doc_tokens - 1) div {window}")
    cut = placed.withColumn("sequence_id", F.explode(F.sequence(F.expr(f"_at div {window}"), last)))
    edge = F.col("sequence_id") * window
    begin, end = F.greatest("_at", edge), F.least(F.col("_at") + F.col("doc_tokens"), edge + window)
    piece = F.expr("substring(ids, cast(start * 4 + 1 as int), cast(length * 4 as int))")
    measured = cut.withColumns(
        {"start": begin - F.col("_at"), "length": end - begin, "offset": begin - edge}
    )
    return measured.select(
        f"`{id}`", "start", "length", "doc_tokens", "sequence_id", "offset", piece.alias("ids")
    )


def sequences(pieces: DataFrame, pad_id: int, window: int = WINDOW) -> DataFrame:
    """Whole sequences: ``(sequence_id, n_tokens, ids)``.

    A sequence is at most ``window`` ids, so its group is bounded. A short one is
    padded with ``pad_id`` to the window unless its length is a power of two.
    """
    gathered = pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("_pieces"),
    )
    joined = F.aggregate("_pieces", F.lit(b""), lambda ids, p: F.concat(ids, p["ids"]))
    whole = F.expr("bit_count(n_tokens)") == 1
    pad = F.unhex(F.repeat(F.lit(struct.pack("<I", pad_id).hex()), F.lit(window) - F.col("n_tokens")))
    ids = F.when(whole, joined).otherwise(F.concat(joined, pad))
    return gathered.select("sequence_id", "n_tokens", ids.alias("ids"))
