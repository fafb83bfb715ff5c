"""Language identification by a small convolutional network over bytes.

Bytes are embedded, filters of several widths slide over a fixed-length window, the
largest response of each filter is kept, and a softmax layer votes. Training runs in
numpy on a bounded, hash-drawn sample of labelled texts. For scoring, embedding and
filters are folded into tables that give the response to a byte pair at once; every
window of every text is scored and the votes of a text are averaged by length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.llm.common import map_rows, uniform, utf8

UNKNOWN = "und"
WINDOW = 512
WIDTHS = (2, 3, 4)
FILTERS, EMBEDDING = 8, 8
TEXTS_PER_LANGUAGE, WINDOWS_PER_TEXT = 1500, 4
LANGUAGES, MOST_TEXTS = 1000, 50_000
EPOCHS, BATCH, RATE = 6, 64, 0.01
PAD = 0x20
CHUNK = 64  # windows scored together: their responses stay in the processor's cache


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray  # 256 x e
    filters: list[np.ndarray]  # (width * e) x f each
    bias: np.ndarray
    dense: np.ndarray  # features x languages
    offset: np.ndarray

    def tables(self) -> list[list[np.ndarray]]:
        """For each width, response tables of byte pairs, then of a last single byte."""
        made = []
        for width, filters in zip(WIDTHS, self.filters):
            one = [
                (self.embedding @ filters[j * EMBEDDING : (j + 1) * EMBEDDING]).astype(np.float32)
                for j in range(width)
            ]
            parts = [
                (one[j][:, None] + one[j + 1][None]).reshape(65536, FILTERS)
                for j in range(0, width - 1, 2)
            ]
            made.append(parts + ([one[-1]] if width % 2 else []))
        return made

    def votes(self, windows: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        """Logits of byte windows (n x WINDOW)."""
        features = np.empty((len(windows), len(WIDTHS) * FILTERS), np.float32)
        for begin in range(0, len(windows), CHUNK):
            part = windows[begin : begin + CHUNK].astype(np.int32)
            pairs = part[:, :-1] * 256 + part[:, 1:]
            for k, (width, parts) in enumerate(zip(WIDTHS, tables)):
                places = WINDOW - width + 1
                response = parts[0].take(pairs[:, :places], axis=0)
                for j, table in enumerate(parts[1:], 1):
                    source = pairs if len(table) == 65536 else part
                    response += table.take(source[:, 2 * j : 2 * j + places], axis=0)
                features[begin : begin + CHUNK, k * FILTERS : (k + 1) * FILTERS] = response.max(axis=1)
        return np.maximum(features + self.bias, 0) @ self.dense + self.offset


def cut_windows(codes: np.ndarray) -> np.ndarray:
    """All windows of one text, the last one padded with blanks."""
    count = -(-len(codes) // WINDOW)
    windows = np.full(count * WINDOW, PAD, np.uint8)
    windows[: len(codes)] = codes
    return windows.reshape(count, WINDOW)


def train_network(windows: np.ndarray, target: np.ndarray, languages: list[str], seed: int = 7) -> Network:
    """Adam on the cross entropy; only the largest response of a filter has a gradient."""
    rng = np.random.default_rng(seed)
    count = len(WIDTHS) * FILTERS
    weights = {
        "embedding": rng.normal(0, 0.5, (256, EMBEDDING)),
        "bias": np.zeros(count),
        "dense": rng.normal(0, count**-0.5, (count, len(languages))),
        "offset": np.zeros(len(languages)),
    }
    for w in WIDTHS:
        weights[f"filter{w}"] = rng.normal(0, (w * EMBEDDING) ** -0.5, (w * EMBEDDING, FILTERS))
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    share = np.bincount(target, minlength=len(languages))
    balance = len(target) / len(languages) / np.maximum(share, 1)
    step = 0
    for epoch in range(EPOCHS):
        for rows in np.array_split(rng.permutation(len(windows)), max(1, len(windows) // BATCH)):
            part, goal = windows[rows], target[rows]
            n = len(rows)
            embedded = weights["embedding"][part]
            features, chosen = [], []
            for w in WIDTHS:
                seen = sliding_window_view(embedded, w, axis=1).transpose(0, 1, 3, 2)
                seen = seen.reshape(n, WINDOW - w + 1, w * EMBEDDING)
                response = seen @ weights[f"filter{w}"]
                place = response.argmax(axis=1)
                chosen.append((place, np.take_along_axis(seen, place[:, :, None], axis=1)))
                features.append(np.take_along_axis(response, place[:, None], axis=1)[:, 0])
            raw = np.hstack(features) + weights["bias"]
            active = np.maximum(raw, 0)
            logits = active @ weights["dense"] + weights["offset"]
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(n), goal] -= 1
            p *= balance[goal][:, None] / n
            back = (p @ weights["dense"].T) * (raw > 0)
            slopes = {"dense": active.T @ p, "offset": p.sum(axis=0), "bias": back.sum(axis=0)}
            slopes["embedding"] = np.zeros_like(weights["embedding"])
            for k, w in enumerate(WIDTHS):
                place, patch = chosen[k]  # n x f, n x f x (w * e)
                own = back[:, k * FILTERS : (k + 1) * FILTERS]
                slopes[f"filter{w}"] = np.einsum("nf,nfd->df", own, patch)
                spread = own[:, :, None] * weights[f"filter{w}"].T[None]
                spread = spread.reshape(n, FILTERS, w, EMBEDDING)
                for j in range(w):
                    codes = np.take_along_axis(part, place + j, axis=1)
                    np.add.at(slopes["embedding"], codes, spread[:, :, j])
            step += 1
            for name, slope in slopes.items():
                first[name] = 0.9 * first[name] + 0.1 * slope
                second[name] = 0.999 * second[name] + 0.001 * slope**2
                size = first[name] / (1 - 0.9**step)
                weights[name] -= RATE * 0.6**epoch * size / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
    return Network(
        languages,
        weights["embedding"],
        [weights[f"filter{w}"] for w in WIDTHS],
        weights["bias"],
        weights["dense"],
        weights["offset"],
    )


def sample_windows(texts: pa.Array, seeds: list[int]) -> list[bytes]:
    """Up to WINDOWS_PER_TEXT stretches from all over each text, of random lengths
    in part, end to end; each is padded to a window."""
    data, bounds = utf8(texts)
    whole, result = np.frombuffer(data, np.uint8), []
    for begin, end, seed in zip(bounds, bounds[1:], seeds):
        rng = np.random.default_rng(seed & 0x7FFFFFFF)
        picked = []
        for k in range(min(WINDOWS_PER_TEXT, 1 + (end - begin) // WINDOW) if end > begin else 0):
            length = WINDOW if k % 2 else int(rng.integers(24, WINDOW + 1))
            at = begin + int(rng.integers(0, max(1, end - begin - length)))
            picked.append(cut_windows(whole[at : min(end, at + length)])[0].tobytes())
        result.append(b"".join(picked))
    return result


def train_langid(
    df: DataFrame,
    usable: Column,
    *,
    id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    texts_per_language: int = TEXTS_PER_LANGUAGE,
    languages: int = LANGUAGES,
    most_texts: int = MOST_TEXTS,
) -> Network | None:
    """A network learned from the rows for which ``usable`` holds.

    About ``texts_per_language`` texts of each language are drawn by hash of the id, or
    fewer where that would be ``most_texts`` in all, and a few windows of each reach the
    driver; no more than twice as many texts do, also if an id is repeated. The
    ``languages`` most frequent languages are learned (ties: the smaller name). Rows with
    a null or empty text, language or id teach nothing. None if no row is left.
    """
    known = df.filter(usable & F.col(lang).isNotNull() & (F.length(text) > 0) & F.col(id).isNotNull())
    known = known.select(F.col(lang).alias("_lang"), F.col(text).alias("_text"), F.col(id).alias("_id"))
    counts = known.groupBy("_lang").count().orderBy(F.desc("count"), "_lang").limit(languages).collect()
    if not counts:
        return None
    each = max(1, min(texts_per_language, most_texts // len(counts)))
    shares = [(r["_lang"], min(1.0, each / r["count"])) for r in counts]
    table = F.broadcast(df.sparkSession.createDataFrame(shares, "_lang string, _share double"))
    drawn = known.join(table, "_lang").filter(uniform("_id", seed=1) < F.col("_share"))
    drawn = drawn.withColumn("_seed", F.xxhash64("_id"))

    def run(texts: pa.Array, seeds: pa.Array) -> list[pa.Array]:
        return [pa.array(sample_windows(texts, seeds.to_pylist()), pa.binary())]

    rows = map_rows(drawn, ["_text", "_seed"], "windows binary", run, keep=["_lang", "_seed"])
    some = rows.orderBy("_seed", "_lang", "windows").limit(2 * each * len(counts))
    table = some.toArrow().sort_by([("_seed", "ascending")])
    names = sorted(l for l, _ in shares)
    number = {l: i for i, l in enumerate(names)}
    windows, target = [], []
    for l, joined in zip(table.column("_lang").to_pylist(), table.column("windows").to_pylist()):
        part = np.frombuffer(joined, np.uint8).reshape(-1, WINDOW)
        windows.append(part)
        target += [number[l]] * len(part)
    return train_network(np.concatenate(windows), np.array(target), names)


def identify_language(
    df: DataFrame, network: Network | None, *, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Adds ``lang_pred`` and ``score``, the probability of that language.

    ``und`` with score 0 for texts that are null or have no letter, and for all texts
    without a network. Every window of a text counts. Rows are independent: repeated
    rows and null ids stay as they are, an empty table gives none, and columns already
    named like the two are replaced.
    """

    def run(texts: pa.Array) -> list[pa.Array]:
        values = texts.to_pylist()
        lettered = [bool(v) and network is not None and any(map(str.isalpha, v)) for v in values]
        del values
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if any(lettered):
            data, bounds = utf8(texts)
            whole, tables = np.frombuffer(data, np.uint8), network.tables()
            waiting, rows, size = [], [], 0
            sums = np.zeros((len(texts), len(network.languages)))

            def flush():
                votes = network.votes(np.concatenate([w for w, _ in waiting]), tables)
                weight = np.concatenate([s for _, s in waiting])
                np.add.at(sums, np.concatenate(rows), votes * weight[:, None])

            for i, ok in enumerate(lettered):
                if ok:
                    # A long text goes through in blocks of windows.
                    for at in range(bounds[i], bounds[i + 1], 4096 * WINDOW):
                        codes = whole[at : min(bounds[i + 1], at + 4096 * WINDOW)]
                        windows = cut_windows(codes)
                        share = np.full(len(windows), WINDOW / (bounds[i + 1] - bounds[i]))
                        share[-1] = (len(codes) - (len(windows) - 1) * WINDOW) / (bounds[i + 1] - bounds[i])
                        waiting.append((windows, share))
                        rows.append(np.full(len(windows), i))
                        size += len(windows)
                        if size >= 4096:
                            flush()
                            waiting, rows, size = [], [], 0
            if size:
                flush()
            p = np.exp(sums - sums.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            for i, ok in enumerate(lettered):
                if ok:
                    k = int(p[i].argmax())
                    names[i], scores[i] = network.languages[k], float(p[i, k])
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

    return map_rows(df, [text], "lang_pred string, score double", run, keep=keep)
