"""Token counts that follow edits.

For each document a segment tree is kept over its pre-tokens: the leaves are blocks
of pre-tokens with their lengths and token counts, inner nodes hold the sums of
both. An edit re-encodes only the pre-tokens it touches and those whose borders may
depend on it: cutting starts a few characters before the edit, at a border that
nothing after it can move, and stops at the first border behind the edit that was
one before. The new pre-tokens replace the old ones in their blocks, and the sums
above those blocks are updated.
"""

from __future__ import annotations

import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from weft.llm.bpe import LONGEST_KEPT, PIECES_KEPT, WORDS_KEPT, WORDWISE, Merges, evenly_spaced, read_ranks
from weft.llm.common import Memo, held, map_rows

BLOCK = 64
#: Under a WORDWISE pattern a border between pre-tokens is decided by at most so many
#: characters after it: its longest contraction has three, the first of them before it.
AHEAD = 3
EDITS = "array<struct<start:int,end:int,text:string>>"


class Counter:
    """Lengths and token counts of the pre-tokens of a text."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.merges = Merges(read_ranks(path))
        self.cut, self.wordwise = regex.compile(pattern), pattern in WORDWISE
        self.pieces = Memo(lambda piece: len(self.merges.encode(piece.encode())), PIECES_KEPT)
        self.first = Memo(lambda word: self._word("", word), PIECES_KEPT)
        self.spaced = Memo(lambda word: self._word(" ", word), WORDS_KEPT)

    def count(self, piece: str) -> int:
        if len(piece) <= LONGEST_KEPT:
            return self.pieces[piece]
        return len(self.merges.encode(piece.encode()))

    def _split(self, text: str) -> bytes:
        pairs = [x for m in self.cut.finditer(text) if (p := m[0]) for x in (len(p), self.count(p))]
        return struct.pack(f"<{len(pairs)}i", *pairs)

    def _word(self, blank: str, word: str) -> bytes:
        if word.isalpha():  # letters alone are one piece
            piece = blank + word
            return struct.pack("<2i", len(piece), len(self.merges.encode(piece.encode())))
        return self._split(blank + word)

    def tree(self, text: str) -> Tree:
        return Tree(self.leaves(text) if text else np.zeros((0, 2), np.int32))

    def leaves(self, text: str) -> np.ndarray:
        """One row (characters, tokens) per pre-token."""
        if not self.wordwise or not evenly_spaced(text):
            data = self._split(text)
        else:
            spaced, parts = self.spaced.__getitem__, []
            for line in text.split("\n"):
                words = line.split(" ")
                parts.append(self.first[words[0]])
                parts.extend(map(spaced, words[1:]))
                parts.append(self.first["\n"])
            data = b"".join(parts[:-1])
        return np.frombuffer(data, np.int32).reshape(-1, 2)


def _sums(leaves: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the blocks that begin at ``starts`` and of all nodes above: node 1 is
    the root, and those below node i are 2 i and 2 i + 1."""
    width = 1 << (len(starts) - 1).bit_length()
    sums = np.zeros((2 * width, 2), np.int64)
    if len(leaves):
        sums[width : width + len(starts)] = np.add.reduceat(leaves, starts, axis=0)
    while width > 1:
        width //= 2
        sums[width : 2 * width] = sums[2 * width : 4 * width : 2] + sums[2 * width + 1 : 4 * width : 2]
    return sums


class Tree:
    """Blocks of pre-tokens below a complete binary tree of sums."""

    def __init__(self, leaves: np.ndarray, sizes: np.ndarray | None = None, sums: np.ndarray | None = None):
        if sizes is None:
            starts = np.arange(0, max(1, len(leaves)), BLOCK)
            sizes = np.append(starts[1:], len(leaves)) - starts
            sums = _sums(leaves, starts)
        self.leaves, self.sizes, self.sums = leaves, sizes, sums
        self.width = len(sums) // 2
        self._blocks: list[np.ndarray] | None = None

    @property
    def blocks(self) -> list[np.ndarray]:
        if self._blocks is None:
            self._blocks = np.split(self.leaves, np.cumsum(self.sizes)[:-1])
        return self._blocks

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def locate(self, place: int) -> tuple[int, int, int]:
        """Block, number in the block and first character of the pre-token that holds
        the character ``place``; at the end of the text, one past the last one."""
        if place >= self.sums[1, 0]:
            return len(self.blocks) - 1, len(self.blocks[-1]), int(self.sums[1, 0])
        node, begin = 1, 0
        while node < self.width:
            node *= 2
            if place >= begin + self.sums[node, 0]:
                begin += int(self.sums[node, 0])
                node += 1
        block = node - self.width
        ends = begin + np.cumsum(self.blocks[block][:, 0])
        k = int(np.searchsorted(ends, place, side="right"))
        return block, k, int(ends[k] - self.blocks[block][k, 0])

    def replace(self, first: tuple[int, int], last: tuple[int, int], leaves: np.ndarray) -> None:
        """Puts ``leaves`` in place of those from ``first`` up to before ``last``."""
        (b, i), (c, k) = first, last
        rest = self.blocks[c][k:]
        if b == c:
            self.blocks[b] = np.concatenate([self.blocks[b][:i], leaves, rest])
        else:
            self.blocks[b] = np.concatenate([self.blocks[b][:i], leaves])
            for between in range(b + 1, c):
                self.blocks[between] = rest[:0]
            self.blocks[c] = rest
        for block in range(b, c + 1):
            node = block + self.width
            self.sums[node] = self.blocks[block].sum(axis=0)
            while node > 1:
                node //= 2
                self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]

    def balanced(self) -> Tree:
        """The same leaves in even blocks, if some block has grown large."""
        if max(map(len, self.blocks)) <= 8 * BLOCK:
            return self
        return Tree(np.concatenate(self.blocks))

    def dump(self) -> bytes:
        leaves, sizes = self.leaves, self.sizes
        if self._blocks is not None:
            leaves, sizes = np.concatenate(self._blocks), np.array(list(map(len, self._blocks)))
        head = struct.pack("<2i", len(leaves), len(sizes))
        return b"".join([head, leaves.tobytes(), sizes.astype(np.int32).tobytes(), self.sums.tobytes()])

    @classmethod
    def load(cls, data: bytes) -> Tree:
        leaves, blocks = np.frombuffer(data, np.int32, 2).tolist()
        end = 8 + 8 * leaves
        sizes = np.frombuffer(data, np.int32, blocks, end)
        sums = np.frombuffer(data, np.int64, -1, end + 4 * blocks).reshape(-1, 2).copy()
        return cls(np.frombuffer(data, np.int32, 2 * leaves, 8).reshape(-1, 2), sizes, sums)


def edited(text: str, tree: Tree, edits: list[tuple[int, int, str]], counter: Counter) -> tuple[str, Tree, int]:
    """The edited text, its tree, and how many pre-tokens were encoded for it.

    ``edits`` are in the places of ``text``; each replaces the characters from start
    to end. They are clamped to the text and taken by start; one that begins before
    the end of another is left out.
    """
    taken, parts, at, size = [], [], 0, 0
    for start, end, new in sorted(edits, key=lambda e: e[:2]):
        start, end = max(0, min(start, len(text))), max(0, min(max(start, end), len(text)))
        if start >= at or not taken:
            parts += [text[at:start], new]
            size += start - at
            taken.append((start, end, size, size + len(new)))  # in the old and the new text
            at, size = end, size + len(new)
    if not taken:
        return text, tree, 0
    fresh = "".join([*parts, text[at:]])
    if not counter.wordwise:  # a border may depend on anything behind it
        leaves = counter.leaves(fresh) if fresh else np.zeros((0, 2), np.int32)
        return fresh, Tree(leaves), len(leaves)
    changes, k, behind, encoded = [], 0, 0, 0
    while k < len(taken):
        first = tree.locate(max(behind, taken[k][0] - AHEAD))
        shift = taken[k - 1][3] - taken[k - 1][1] if k else 0
        leaves, place = [], first[2] + shift
        last = None
        while last is None:
            while k + 1 < len(taken) and place > taken[k + 1][2] - AHEAD:
                k += 1  # the region reaches the next edit
            old = place - taken[k][3] + taken[k][1]
            if place >= taken[k][3]:
                found = tree.locate(old)
                if found[2] == old:
                    last = found
                    break
            piece = counter.cut.match(fresh, place)[0]
            leaves.append((len(piece), counter.count(piece)))
            place += len(piece)
        encoded += len(leaves)
        changes.append((first[:2], last[:2], np.array(leaves, np.int32).reshape(-1, 2)))
        behind, k = old, k + 1
    for change in reversed(changes):
        tree.replace(*change)
    return fresh, tree.balanced(), encoded


def _counter(path: str, pattern: str) -> Counter:
    return held(f"counts:{path}:{pattern}", lambda: Counter(path, pattern))


def count_tokens(
    df: DataFrame, path: str, pattern: str, *, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Adds ``n_tokens`` and ``tree``, the segment tree of the text.

    Tokens are those of byte-level BPE by the rank file ``path``, of texts of any length.
    Null and empty texts have no tokens. Rows are independent: repeated rows and null ids stay as
    they are, an empty table gives none, and columns already named like the two are
    replaced.
    """

    def run(texts: pa.Array) -> list[pa.Array]:
        counter = _counter(path, pattern)
        trees = [counter.tree(t or "") for t in texts.to_pylist()]
        return [pa.array([t.tokens for t in trees], pa.int64()), pa.array([t.dump() for t in trees], pa.binary())]

    return map_rows(df, [text], "n_tokens long, tree binary", run, keep=keep)


def recount_tokens(
    df: DataFrame,
    path: str,
    pattern: str,
    edits: str | tuple[str, str],
    *,
    text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """Applies edits to texts with a ``tree`` and counts anew. Without that column the
    trees are made in the same pass, and ``n_tokens`` is added.

    ``edits`` names a column of the type EDITS (see :func:`edited`), or is a regular
    expression and what replaces each of its matches. Adds ``edited_text``,
    ``edited_tokens``, ``edited_tree``, ``n_edits`` and ``n_encoded``, the number of
    pre-tokens that had to be encoded. Null texts are empty ones, null edits are
    none, and a null replacement is empty. Rows are independent; columns already
    named like the new ones are replaced.
    """
    named, kept_trees = isinstance(edits, str), "tree" in df.columns

    def run(texts: pa.Array, *more: pa.Array) -> list[pa.Array]:
        counter, rows = _counter(path, pattern), []
        trees = [c.as_py() for c in more[0]] if kept_trees else [None] * len(texts)
        if named:
            wanted = [
                [(e["start"], e["end"], e["text"] or "") for e in es or []] for es in more[-1].to_pylist()
            ]
        else:
            find = re.compile(edits[0]).finditer
            wanted = [[(m.start(), m.end(), edits[1]) for m in find(t or "")] for t in texts.to_pylist()]
        for body, data, triples in zip(texts.to_pylist(), trees, wanted):
            new, encoded = body or "", 0
            tree = counter.tree(new) if data is None else Tree.load(data)
            before = tree.tokens
            if triples:
                new, tree, encoded = edited(new, tree, triples, counter)
            if triples or data is None:
                data = tree.dump()
            rows.append((new, tree.tokens, data, len(triples), encoded, before))
        kinds = [pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        columns = zip(*rows) if rows else [[]] * 6
        made = [pa.array(c, k) for c, k in zip(columns, kinds)]
        return made[:-1] if kept_trees else made

    made = "edited_text string, edited_tokens long, edited_tree binary, n_edits long, n_encoded long"
    inputs = [text, *(["tree"] if kept_trees else []), *([edits] if named else [])]
    return map_rows(df, inputs, made + ", n_tokens long" * (not kept_trees), run, keep=keep)
