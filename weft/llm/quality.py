"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of whole texts are taken in Arrow batches. Trees are fitted on a bounded
sample of labelled rows, cut into histogram bins, and kept as complete binary trees
in flat arrays, so that a batch goes down all trees at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.common import map_rows, uniform, utf8

SAMPLE_ROWS = 20_000
TREES, DEPTH, BINS = 80, 4, 64
RATE, RIDGE, LEAST_WEIGHT = 0.15, 1.0, 2.0

_CLASSES = [
    b"abcdefghijklmnopqrstuvwxyz",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b" ",
    b"\n",
    b".,;:",
    b"!?",
    b"|<>{}[]\\",
    b"#$%&*@^~=+_`",
    bytes(range(128, 256)),
    bytes(range(32)),
]
CLASSES = np.zeros((256, len(_CLASSES)))
for _i, _c in enumerate(_CLASSES):
    CLASSES[np.frombuffer(_c, np.uint8), _i] = 1
MARK = np.zeros(256, bool)
MARK[np.frombuffer(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", np.uint8)] = True


def statistics(column: pa.Array) -> np.ndarray:
    """One row of statistics per text; null and empty texts give zeros."""
    data, bounds = utf8(column)
    whole = np.frombuffer(data, np.uint8)
    counts = np.zeros((len(bounds) - 1, 256))
    rest = np.zeros((len(bounds) - 1, 14))
    for i, (begin, end) in enumerate(zip(bounds, bounds[1:])):
        if begin == end:
            continue
        codes, row = whole[begin:end], data[begin:end]
        counts[i] = np.bincount(codes, minlength=256)
        words, lines = row.split(), row.split(b"\n")
        n = len(words) or 1
        lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
        marks = MARK[codes]
        rest[i] = (
            np.log1p(end - begin),
            np.log1p(len(words)),
            lengths.mean(),
            lengths.std(),
            np.log1p(lengths.max()),
            (lengths <= 3).mean(),
            (lengths > 12).mean(),
            len(set(words)) / n,
            len(lines) / n,
            len(set(lines)) / len(lines),
            np.count_nonzero(marks[1:] & marks[:-1]) / len(codes),
            np.count_nonzero(codes[1:] == codes[:-1]) / len(codes),
            row.isupper(),
            row.count(b". ") / n,
        )
    size = np.maximum(counts.sum(axis=1, keepdims=True), 1)
    shares = counts / size
    entropy = -(shares * np.log2(np.maximum(shares, 1e-12))).sum(axis=1, keepdims=True)
    return np.hstack([shares @ CLASSES, entropy, (counts > 0).sum(axis=1, keepdims=True), rest])


@dataclass
class Trees:
    """Complete trees: ``feature`` and ``threshold`` of inner nodes, ``value`` of leaves."""

    start: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        total = np.full(len(x), self.start)
        if self.value.size:
            trees = np.arange(len(self.value))
            rows = np.arange(len(x))[:, None]
            at = np.zeros((len(x), len(trees)), np.int64)
            for _ in range(int(np.log2(self.value.shape[1]))):
                right = x[rows, self.feature[trees, at]] > self.threshold[trees, at]
                at = 2 * at + 1 + right
            total += self.value[trees, at - self.feature.shape[1]].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boosting on logistic loss; split gains come from histograms of all nodes of
    a level. Without rows or with one label only the start value is fitted."""
    prior = np.clip((y.sum() + 0.5) / (len(y) + 1), 1e-3, 1 - 1e-3)
    inner = 2**depth - 1
    model = Trees(
        float(np.log(prior / (1 - prior))),
        np.zeros((0, inner), np.int64),
        np.zeros((0, inner)),
        np.zeros((0, inner + 1)),
    )
    if len(set(y.tolist())) < 2:
        return model
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS)[1:-1])) for j in range(width)]
    bins = np.stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(edges)], axis=1)
    cells = bins + np.arange(width) * BINS
    score = np.full(n, model.start)
    feature = np.zeros((trees, inner), np.int64)
    threshold = np.full((trees, inner), np.inf)
    value = np.zeros((trees, inner + 1))
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        slope, weight = p - y, p * (1 - p)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            place = ((at - first)[:, None] * (width * BINS) + cells).ravel()
            size, shape = nodes * width * BINS, (nodes, width, BINS)
            g = np.bincount(place, np.repeat(slope, width), size).reshape(shape).cumsum(axis=2)
            h = np.bincount(place, np.repeat(weight, width), size).reshape(shape).cumsum(axis=2)
            gs, hs = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + RIDGE) + (gs - g) ** 2 / (hs - h + RIDGE) - gs**2 / (hs + RIDGE)
            gain[(h < LEAST_WEIGHT) | (hs - h < LEAST_WEIGHT)] = 0
            best = gain.reshape(nodes, -1).argmax(axis=1)
            for k in range(nodes):
                j, b = divmod(int(best[k]), BINS)
                if gain[k, j, b] > 1e-9 and b < len(edges[j]):
                    feature[t, first + k], threshold[t, first + k] = j, edges[j][b]
            right = x[np.arange(n), feature[t, at]] > threshold[t, at]
            at = 2 * at + 1 + right
        leaf = at - inner
        sums = np.bincount(leaf, slope, inner + 1), np.bincount(leaf, weight, inner + 1)
        value[t] = -RATE * sums[0] / (sums[1] + RIDGE)
        score += value[t][leaf]
    return Trees(model.start, feature, threshold, value)


def train_quality(
    df: DataFrame,
    labels: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> Trees:
    """Trees fitted on labelled documents.

    About ``sample_rows`` labels, drawn by hash of the id, are used at most (all, if
    there are fewer). They are the broadcast side of a join with the texts, so the
    texts are not moved, and only the statistics of at most ``2 * sample_rows`` of them
    reach the driver: of more, as when a labelled id is repeated, the first by a hash of
    the id and by statistics. Labels with a null id or label are ignored; a document with
    two labels counts twice.
    """
    usable = labels.select(F.col(id).alias("_id"), F.col(label).cast("double").alias("_y"))
    usable = usable.filter(F.col("_id").isNotNull() & F.col("_y").isNotNull())
    share = min(1.0, sample_rows / max(1, usable.count()))
    drawn = usable.filter(uniform("_id") < share).limit(2 * sample_rows)
    matched = df.select(F.col(id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(drawn), "_id")

    def run(texts: pa.Array) -> list[pa.Array]:
        return [pa.array(list(statistics(texts)), pa.list_(pa.float64()))]

    rows = map_rows(matched, ["_text"], "x array<double>", run, keep=["_id", "_y"])
    some = rows.orderBy(F.xxhash64("_id"), "_id", "_y", "x").limit(2 * sample_rows)
    table = some.toArrow().sort_by("_id")  # so that the order of tasks has no effect
    x = np.array(table.column("x").to_pylist(), float)
    return fit_trees(x, table.column("_y").to_numpy())


def score_quality(
    df: DataFrame, model: Trees, *, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Adds ``score``, the probability that a text is good, from 0 to 1.

    Null and empty texts are scored like a text whose statistics are all zero. Rows
    are independent: repeated rows and null ids stay as they are, an empty table
    gives none, and a column already named ``score`` is replaced.
    """

    def run(texts: pa.Array) -> list[pa.Array]:
        return [pa.array(model.scores(statistics(texts)), pa.float64())]

    return map_rows(df, [text], "score double", run, keep=keep)
