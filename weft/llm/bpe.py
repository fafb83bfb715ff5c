"""Byte-level BPE by backtracking from longest matches, and its inverse.

The bytes of a piece are mapped to Latin-1 characters, and an Aho-Corasick
automaton over all tokens finds every token at every position. The encoding takes
the longest token that fits its predecessor; if no token fits, it goes back one
token and tries the next shorter one. Two neighbours fit if merging by rank would
leave the border between them alone. That is looked up by undoing the merges on
both sides of the border, and it is memoised. A position from which no encoding
reaches the end is marked, so no position is left more than once per token that
starts there, and the time is linear in the length of the piece.
"""

from __future__ import annotations

import base64
import struct
from array import array

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from weft.llm.common import Memo, held, map_rows

WORDS_KEPT = 150_000
PIECES_KEPT = 30_000
LONGEST_KEPT = 64
FITS_KEPT = 150_000


#: Patterns that begin a piece at a single blank or line end between words, whatever
#: stands around it, and leave letters alone whole; words are looked up under these only.
WORDWISE = {public_tokenizers.PATTERN}


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a file of base64 and rank lines."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Merges:
    """Tokens, what each is merged from, and which neighbours fit."""

    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.halves: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        self.automaton = ahocorasick.Automaton()
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) > 1:
                halves = self._last_merge(token, rank)
                if halves is None:
                    continue  # no merge makes it; only a piece that equals it becomes it
                self.halves[rank] = halves
                self.joined[halves] = rank
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        # Every byte is a token, so the first match from a place begins there.
        self.longest = self.automaton.iter_long
        self.length = {rank: len(token) for token, rank in ranks.items()}
        self.shorter = Memo(self._shorter, len(ranks))
        self.fits = Memo(self._fits, FITS_KEPT)

    def _last_merge(self, token: bytes, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            pairs = [self.ranks.get(a + b, rank) for a, b in zip(parts, parts[1:])]
            best = min(pairs)
            if best >= rank:
                return None
            i = pairs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        a, b = (self.ranks.get(p) for p in parts)
        return None if a is None or b is None else (a, b)

    def _shorter(self, rank: int) -> int:
        """The longest token that is a proper prefix, or -1."""
        token = self.tokens[rank]
        prefixes = (self.ranks.get(token[:k], -1) for k in range(len(token) - 1, 0, -1))
        merged = self.halves
        return next((r for r in prefixes if r in merged or self.length.get(r) == 1), -1)

    def _fits(self, pair: tuple[int, int]) -> bool:
        """Whether no merge across the border comes before a merge beside it.

        Both sides are taken apart from the last merge backwards. ``bound`` is the
        rank of the merge undone last: a pair across the border whose merge comes
        earlier would have been taken first. Equal ranks merge from the left, so
        undoing the right side lets a merge of the same rank across the border win.
        """
        left, right = pair
        joined, halves, bound = self.joined, self.halves, 1 << 62
        while True:
            if joined.get((left, right), bound) < bound:
                return False
            a, b = halves.get(left), halves.get(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and left > right):
                bound, left = left, a[1]
            else:
                bound, right = right + 1, b[0]

    def encode(self, piece: bytes) -> list[int]:
        """The ids of one piece."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        size, last = len(piece), -1
        longest, shorter, fits = self.longest, self.shorter, self.fits
        length, dead = self.length, set()
        letters, at = piece.decode("latin-1"), 0
        rank = next(longest(letters, 0))[1]
        ids: list[int] = []
        while True:
            while rank >= 0 and (at + length[rank] in dead or not (last < 0 or fits[last, rank])):
                rank = shorter[rank]
            if rank >= 0:
                ids.append(rank)
                at += length[rank]
                if at == size:
                    return ids
                last, rank = rank, next(longest(letters, at))[1]
            else:
                dead.add(at)
                rank = ids.pop()
                at -= length[rank]
                last, rank = ids[-1] if ids else -1, shorter[rank]


def evenly_spaced(text: str) -> bool:
    """Whether single blanks and line ends are the only white space, none of them at
    an end of the text, and no word is very long.

    Then a WORDWISE pattern begins a piece at each blank and line end.
    """
    words = text.split()
    gaps = text.count(" ") + text.count("\n")
    single = len(words) == gaps + 1 and len("".join(words)) + gaps == len(text)
    return single and max(map(len, words)) <= LONGEST_KEPT


def ids_bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """Encodes texts; words seen before are looked up."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.merges = Merges(read_ranks(path))
        self.wordwise = pattern in WORDWISE
        find = regex.compile(pattern)
        self.find = find.findall if self.wordwise else lambda text: [m[0] for m in find.finditer(text) if m[0]]
        self.pieces = Memo(self._piece, PIECES_KEPT)
        self.first = Memo(lambda word: self._word("", word), PIECES_KEPT)
        self.spaced = Memo(lambda word: self._word(" ", word), WORDS_KEPT)

    def _piece(self, piece: str) -> bytes:
        return ids_bytes(self.merges.encode(piece.encode()))

    def _split(self, text: str) -> bytes:
        pieces, plain = self.pieces, self._piece
        return b"".join([pieces[p] if len(p) <= LONGEST_KEPT else plain(p) for p in self.find(text)])

    def _word(self, blank: str, word: str) -> bytes:
        # Letters alone are one piece.
        return self._piece(blank + word) if word.isalpha() else self._split(blank + word)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers.

        Words of evenly spaced texts are looked up under a WORDWISE pattern; other texts
        are cut by the pattern as a whole.
        """
        if not self.wordwise or not evenly_spaced(text):
            return self._split(text)
        first, spaced, parts = self.first, self.spaced.__getitem__, []
        for line in text.split("\n"):
            words = line.split(" ")
            parts.append(first[words[0]])
            parts.extend(map(spaced, words[1:]))
            parts.append(first["\n"])
        parts.pop()
        return b"".join(parts)


def encode_bpe(
    df: DataFrame, path: str, pattern: str, *, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Adds ``ids`` (binary, little-endian unsigned 32-bit) and ``n_tokens``.

    ``pattern`` cuts a text of any length into pieces, each of which is encoded alone by
    the ranks in the file ``path``, which every worker must be able to open; what it does
    not match has no ids. Null and empty texts have none. Rows are independent: repeated rows and null ids stay
    as they are, an empty table gives none, and a column already named ``ids`` or
    ``n_tokens`` is replaced.
    """

    def run(texts: pa.Array) -> list[pa.Array]:
        encode = held(f"bpe:{path}:{pattern}", lambda: Encoder(path, pattern)).encode
        ids = [encode(t) if t else b"" for t in texts.to_pylist()]
        return [pa.array(ids, pa.binary()), pa.array([len(i) // 4 for i in ids], pa.int64())]

    return map_rows(df, [text], "ids binary, n_tokens long", run, keep=keep)


def decode_bpe(df: DataFrame, path: str, *, keep: list[str] | None = None) -> DataFrame:
    """Adds ``decoded``, the bytes that the column ``ids`` stands for.

    Null ids give no bytes. An id that is no rank fails.
    """

    def run(column: pa.Array) -> list[pa.Array]:
        def table():
            ranks = read_ranks(path)
            return {rank: token for token, rank in ranks.items()}.__getitem__

        token = held(f"bpe-tokens:{path}", table)
        texts = []
        for value in column:
            ids = array("I")
            ids.frombytes(value.as_buffer() or b"" if value.is_valid else b"")
            texts.append(b"".join(map(token, ids)))
        return [pa.array(texts, pa.binary())]

    return map_rows(df, ["ids"], "decoded binary", run, keep=keep)
