"""Secret scans: fixed patterns, and formats learned by grammar inference.

The patterns find credentials that announce themselves. Their matches are labelled
examples: for each kind a prefix tree of sampled values is built and its states are
merged as long as their statistics agree, which leaves a probabilistic automaton of
the format. More automata, the background, are learned from tokens that no pattern
matches and that fit none of these formats. Every token of every text is then scored:
it is reported if an automaton of credentials finds it as likely as its own examples
and far likelier than the background does.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.common import BATCH_ROWS, kept, map_rows, uniform, utf8

KINDS = ("assign", "access", "hex")
OTHER = "other"
LIKE = tuple(f"like_{k}" for k in KINDS)
ORDER = {k: i for i, k in enumerate((*KINDS, *LIKE))}

ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE,  # of bytes: ASCII letters only
)
ASSIGN_LEAST = 6
# Both are maximal runs, so the least length may stand in the pattern.
ACCESS = re.compile(rb"AKIA[A-Z0-9]{16,}")
HEX = re.compile(rb"[0-9a-f]{24,}")

LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
RUN_LEAST = 16  # of LETTERS; ``access`` and ``hex`` need more
#: A candidate: a maximal run of LETTERS or of these and ``.=``, as long as a value of ``assign``.
CANDIDATE_LEAST = ASSIGN_LEAST

EXAMPLES = 400  # of each kind, sampled by hash
EXAMPLE_LONGEST = 128
MERGE_ERROR = 0.05  # ALERGIA's confidence parameter
LOW_SHARE, SLACK = 0.02, 0.1  # this share of the examples may score below the bound
MARGIN = 10.0  # nats by which a format must beat other tokens
CLEAR = 2.0  # nats by which a word must be likelier as a word to teach what words are
PART_BYTES = 4 << 20  # of texts scored at once
#: Teach the background in any corpus, so that it is never empty.
PLAIN = b"""about people because through between should children another government different important
example information company however without against something business thought nothing together
Monday January European American However Although Contents.  version.  system.  2019-10-27 12:30:45
www.example.com index.html file_name.txt user-name first/second""".split()

SYMBOLS = len(LETTERS) + 3  # ``.``, ``=`` and any other
SYMBOL = np.full(256, SYMBOLS - 1, np.uint8)
SYMBOL[np.frombuffer(LETTERS + b".=", np.uint8)] = np.arange(len(LETTERS) + 2)
IN_TOKEN = np.zeros(256, bool)
IN_TOKEN[np.frombuffer(LETTERS, np.uint8)] = True
IN_WIDE = SYMBOL < SYMBOLS - 1
DIGITS, LOWER, UPPER = 1, 2, 4
CLASS = np.zeros(256, np.uint8)
CLASS[48:58], CLASS[97:123], CLASS[65:91] = DIGITS, LOWER, UPPER


def _bases(row: bytes, tokens: list[tuple[int, int]]) -> list[tuple[str, int, int, int]]:
    """Matches of the patterns: kind, start, end and start of the credential."""
    found = []
    low = row.lower()
    if b"passw" in low or b"secret" in low or b"token" in low or b"apikey" in low or b"api_key" in low:
        for m in ASSIGN.finditer(row):
            if m.end(2) - m.start(2) >= ASSIGN_LEAST:
                found.append(("assign", m.start(), m.end(), m.start(2)))
    for start, end in tokens:
        for kind, pattern in (("access", ACCESS), ("hex", HEX)):
            found += [(kind, m.start(), m.end(), m.start()) for m in pattern.finditer(row, start, end)]
    return found


def _edges(data: np.ndarray, member: np.ndarray, bounds: list[int], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of members in each text."""
    flags = member[data]
    change = np.zeros(len(data) + 1, bool)
    change[1:-1] = flags[1:] != flags[:-1]
    change[bounds] = True
    cuts = np.flatnonzero(change)
    long = np.flatnonzero((np.diff(cuts) >= least) & flags[cuts[:-1]])
    return cuts[long], cuts[long + 1]


def _parts(texts: pa.Array) -> Iterable[tuple[int, bytes, list[int]]]:
    """The batch in parts of bounded size (or one text): first row, bytes, bounds."""
    data, bounds = utf8(texts)
    first = 0
    for i in range(1, len(bounds)):
        if i + 1 == len(bounds) or bounds[i + 1] - bounds[first] > PART_BYTES:
            low = bounds[first]
            yield first, data[low : bounds[i]], [b - low for b in bounds[first : i + 1]]
            first = i


def _rows(data: bytes, bounds: list[int]) -> Iterable[tuple[int, int, bytes, list[tuple]]]:
    """Number, begin and bytes of each text of a part, and the matches of the patterns."""
    starts, ends = _edges(np.frombuffer(data, np.uint8), IN_TOKEN, bounds, RUN_LEAST) if data else ([], [])
    first = np.searchsorted(starts, bounds)
    for i, (begin, end) in enumerate(zip(bounds, bounds[1:])):
        row = data[begin:end]
        tokens = [(int(starts[k]) - begin, int(ends[k]) - begin) for k in range(first[i], first[i + 1])]
        yield i, begin, row, _bases(row, tokens)


@dataclass
class Tokens:
    """Candidates of a part, by their places in its bytes.

    Runs of the wide alphabet come first; the runs of LETTERS inside one follow,
    with its number as ``parent``. Those that a base span touches are left out.
    """

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    parent: np.ndarray

    @staticmethod
    def of(data: bytes, bounds: list[int], taken: list[tuple[int, int]]) -> Tokens:
        array = np.frombuffer(data, np.uint8)
        if not data:
            none = np.zeros(0, np.int64)
            return Tokens(array, none, none, none)
        starts, ends = _edges(array, IN_WIDE, bounds, CANDIDATE_LEAST)
        s, e = _edges(array, IN_TOKEN, bounds, CANDIDATE_LEAST)
        parent = np.searchsorted(starts, s, "right") - 1
        inner = (starts[parent] != s) | (ends[parent] != e)
        parent = np.concatenate([np.full(len(starts), -1), parent[inner]])
        starts, ends = np.concatenate([starts, s[inner]]), np.concatenate([ends, e[inner]])
        free = np.ones(len(starts), bool)
        if taken:
            low, high = np.array(sorted(taken)).T
            high = np.maximum.accumulate(high)  # of all spans that start no later
            before = np.searchsorted(low, ends) - 1
            free = (before < 0) | (high[before.clip(min=0)] <= starts)
        number = np.cumsum(free) - 1
        known = parent[free]
        known = np.where((known >= 0) & free[known], number[known], -1)
        return Tokens(array, starts[free], ends[free], known)

    def take(self, rows: np.ndarray) -> Tokens:
        return Tokens(self.data, self.starts[rows], self.ends[rows], self.parent[rows])

    def value(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()

    def classes(self) -> np.ndarray:
        """Bits of DIGITS, LOWER and UPPER that occur in each."""
        if not len(self.starts):
            return np.zeros(0, np.uint8)
        places = np.stack([self.starts, self.ends], axis=1).ravel()
        return np.bitwise_or.reduceat(np.append(CLASS[self.data], np.uint8(0)), places)[::2]

    def steps(self) -> tuple[np.ndarray, Iterable[np.ndarray]]:
        """An order, longest first, and for each place the symbols there, in that order."""
        lengths = self.ends - self.starts
        order = np.argsort(-lengths, kind="stable")
        begins, lengths = self.starts[order], lengths[order]

        def walk():
            counts = np.searchsorted(-lengths, -np.arange(1, (lengths[0] if len(lengths) else 0) + 1), "right")
            for k, active in enumerate(counts.tolist()):
                yield SYMBOL[self.data[begins[:active] + k]]

        return order, walk()

    def hashes(self) -> np.ndarray:
        """A number for each value that depends on the value only."""
        up, down = _powers(len(self.data))
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data + np.uint64(1)) * up, out=sums[1:])
        value = (sums[self.ends] - sums[self.starts]) * down[self.starts]
        value = (value ^ (value >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
        value = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (value >> np.uint64(1)).view(np.int64)


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2 ** 64."""
    base = 0x5851F42D4C957F2D
    pair = []
    for number in (base, pow(base, -1, 1 << 64)):
        factors = np.full(count, number, np.uint64)
        factors[:1] = 1
        pair.append(np.cumprod(factors))
    return pair[0], pair[1]


def _tokens(values: list[bytes]) -> Tokens:
    ends = np.cumsum([len(v) for v in values]).astype(np.int64)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if values else ends
    return Tokens(np.frombuffer(b"".join(values), np.uint8), starts, ends, np.full(len(values), -1))


class Automaton:
    """A probabilistic automaton from a prefix tree with merged states."""

    def __init__(self, examples: list[bytes], error: float = MERGE_ERROR):
        self.visits, self.ends, self.edges = [0], [0], [{}]
        self.spread = math.sqrt(0.5 * math.log(2 / error))
        for example in examples:
            at = 0
            self.visits[0] += 1
            for symbol in SYMBOL[np.frombuffer(example, np.uint8)].tolist():
                edge = self.edges[at].setdefault(symbol, [len(self.visits), 0])
                if edge[0] == len(self.visits):
                    self.visits.append(0)
                    self.ends.append(0)
                    self.edges.append({})
                edge[1] += 1
                at = edge[0]
                self.visits[at] += 1
            self.ends[at] += 1
        self._merge_states()
        self._flatten()
        given = _tokens(examples)
        self.low = float(np.quantile(self.walk(given)[1], LOW_SHARE)) - SLACK
        self.usual = np.bincount(given.classes(), minlength=8) >= LOW_SHARE * len(examples)

    def _apart(self, a: int, n: int, b: int, m: int) -> bool:
        """Whether two shares differ by more than chance (Hoeffding's bound)."""
        return abs(a / n - b / m) > self.spread * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def _alike(self, a: int, b: int) -> bool:
        """Whether two states, and those behind them, have like statistics."""
        pairs = [(a, b)]
        while pairs:
            a, b = pairs.pop()
            n, m = self.visits[a], self.visits[b]
            if self._apart(self.ends[a], n, self.ends[b], m):
                return False
            for symbol in self.edges[a].keys() | self.edges[b].keys():
                x, y = self.edges[a].get(symbol, (None, 0)), self.edges[b].get(symbol, (None, 0))
                if self._apart(x[1], n, y[1], m):
                    return False
                if x[0] is not None and y[0] is not None:
                    pairs.append((x[0], y[0]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Adds the tree below ``b`` to the automaton at ``a``."""
        pairs = [(a, b)]
        while pairs:
            a, b = pairs.pop()
            self.visits[a] += self.visits[b]
            self.ends[a] += self.ends[b]
            for symbol, (target, count) in self.edges[b].items():
                edge = self.edges[a].get(symbol)
                if edge is None:
                    self.edges[a][symbol] = [target, count]
                else:
                    edge[1] += count
                    pairs.append((edge[0], target))

    def _merge_states(self) -> None:
        settled, chosen = [0], {0}
        while True:
            open_edges = (
                (s, symbol) for s in settled for symbol, e in sorted(self.edges[s].items()) if e[0] not in chosen
            )
            state, symbol = next(open_edges, (None, None))
            if state is None:
                break
            new = self.edges[state][symbol][0]
            like = next((s for s in settled if self._alike(s, new)), None)
            if like is None:
                settled.append(new)
                chosen.add(new)
            else:
                self.edges[state][symbol][0] = like
                self._fold(like, new)
        self.settled = settled

    def _flatten(self) -> None:
        """Transition and log-probability tables; an unseen symbol stays put."""
        number = {s: i for i, s in enumerate(self.settled)}
        n = len(number)
        self.next = np.repeat(np.arange(n, dtype=np.int32)[:, None], SYMBOLS, axis=1)
        weight = np.full((n, SYMBOLS + 1), 1 / (SYMBOLS + 1))
        for s, i in number.items():
            weight[i, SYMBOLS] += self.ends[s]
            for symbol, (target, count) in self.edges[s].items():
                self.next[i, symbol] = number[target]
                weight[i, symbol] += count
        self.log = np.log(weight / weight.sum(axis=1, keepdims=True))
        del self.visits, self.ends, self.edges, self.settled

    def scores(self, tokens: list[bytes]) -> np.ndarray:
        """Log-likelihood of each token, and its mean over the symbols without the
        end. All tokens are advanced together."""
        return self.walk(_tokens(tokens))

    def walk(self, tokens: Tokens) -> np.ndarray:
        order, steps = tokens.steps()
        state, total = np.zeros(len(order), np.int32), np.zeros(len(order))
        for symbols in steps:
            now = state[: len(symbols)]
            total[: len(symbols)] += self.log[now, symbols]
            state[: len(symbols)] = self.next[now, symbols]
        result = np.empty((2, len(order)))
        result[0, order] = total + self.log[state, SYMBOLS]
        result[1, order] = total
        result[1] /= np.maximum(tokens.ends - tokens.starts, 1)
        return result

    def reaching(self, tokens: Tokens) -> np.ndarray:
        """Rows of the tokens that may be as likely as the examples: those given up
        stay below the bound even if all symbols behind the first ones are the likeliest."""
        rows, lengths = np.arange(len(tokens.starts)), tokens.ends - tokens.starts
        best = float(self.log[:, :SYMBOLS].max())
        state, lost = np.zeros(len(rows), np.int32), np.zeros(len(rows))
        for k in range(CANDIDATE_LEAST):
            symbols = SYMBOL[tokens.data[tokens.starts[rows] + k]]
            lost += self.log[state, symbols] - best
            stay = lost >= (self.low - best) * lengths[rows] - 1e-6
            state = self.next[state, symbols][stay]
            rows, lost = rows[stay], lost[stay]
        return rows

    def fits(self, tokens: Tokens) -> np.ndarray:
        """Whether each token is as likely as the examples and of their classes of characters."""
        return (self.walk(tokens)[1] >= self.low) & self.usual[tokens.classes()]


class Background:
    """Automata of several sorts of other tokens; the likeliest one counts."""

    def __init__(self, samples: list[list[bytes]]):
        self.automata = [Automaton(sample) for sample in samples if sample]

    def walk(self, tokens: Tokens) -> np.ndarray:
        return np.max([a.walk(tokens)[0] for a in self.automata], axis=0)


def _others(df: DataFrame, text: str, formats: dict[str, Automaton], examples: int) -> list[list[bytes]]:
    """Samples of tokens that are no credentials, by sort: without digits, of digits
    only, and mixed, each short and long. The sorts are sampled apart, as words
    outnumber all else.

    What fits a format teaches no background: else leaked keys would hide each other.
    Words may fit a format of random letters; they stay if they are clearly likelier
    by an automaton of all tokens without digits.
    """
    column = F.col(f"`{text}`").alias("text")

    def run(batches):
        least: dict[int, dict[int, bytes]] = {sort: {} for sort in range(6)}
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                for _, data, bounds in _parts(whole.column(0).slice(at, BATCH_ROWS)):
                    add(least, data, bounds)
        made = [(k, h, v.decode()) for k, values in least.items() for h, v in values.items()]
        fields = [pa.array([m[c] for m in made], t) for c, t in enumerate((pa.int32(), pa.int64(), pa.string()))]
        yield pa.RecordBatch.from_arrays(fields, ["sort", "hash", "value"])

    def add(least, data, bounds):
        taken = [(b + x[1], b + x[2]) for _, b, _, bases in _rows(data, bounds) for x in bases]
        tokens = Tokens.of(data, bounds, taken)
        tokens = tokens.take(tokens.ends - tokens.starts <= EXAMPLE_LONGEST)
        classes = tokens.classes()
        digits = (classes & DIGITS) > 0
        fit = np.zeros(len(classes), bool)
        mixed = np.flatnonzero(digits)
        for automaton in formats.values():
            fit[mixed] |= automaton.fits(tokens.take(mixed))
        tokens, classes, digits = tokens.take(~fit), classes[~fit], digits[~fit]
        sort = np.where(digits, np.where(classes == DIGITS, 1, 2), 0) + 3 * (tokens.ends - tokens.starts >= RUN_LEAST)
        hashes = tokens.hashes()
        for k, values in least.items():
            known = len(values) == examples
            rows = np.flatnonzero((sort == k) & (hashes < max(values) if known else True))
            names, first = np.unique(hashes[rows], return_index=True)
            for h, i in zip(names[:examples].tolist(), rows[first[:examples]].tolist()):
                values.setdefault(h, tokens.value(i))
            for h in sorted(values)[examples:]:
                del values[h]

    # Each task gives its smallest hashes; the smallest of all are a sample of all values.
    found = df.select(column).mapInArrow(run, "sort int, hash long, value string").distinct()
    found = kept(found, "others")
    sizes = {r["sort"]: r["n"] for r in found.groupBy("sort").agg(F.count(F.lit(1)).alias("n")).collect()}
    samples = []
    for sort in range(6):
        part = found.filter(F.col("sort") == sort)
        if sizes.get(sort, 0) > examples:
            part = part.filter(F.col("hash") <= part.approxQuantile("hash", [examples / sizes[sort]], 1e-4)[0])
        sample = sorted(r["value"].encode() for r in part.select("value").limit(2 * examples).collect())
        if sort % 3 == 0 and sample:
            tokens = _tokens(sample)
            word = Automaton(sample).walk(tokens)[0]
            stay = np.ones(len(sample), bool)
            for automaton in formats.values():
                stay &= ~automaton.fits(tokens) | (word - automaton.walk(tokens)[0] >= CLEAR)
            sample = [v for v, s in zip(sample, stay) if s]
        samples.append(sample)
    return samples


def learn_formats(df: DataFrame, *, text: str = "text", examples: int = EXAMPLES) -> dict[str, Automaton | Background]:
    """Automata by kind, and the background of other tokens, from ``df``.

    Different values are found in all texts; up to about ``examples`` of each kind
    and of each sort of other tokens are drawn by hash, so the driver gets a bounded
    number of short strings. A kind without examples has no automaton, and without
    any there is no background. Tokens that fit a format teach no background.
    """

    def run(texts: pa.Array) -> list[pa.Array]:
        values = []
        for _, data, bounds in _parts(texts):
            for _, _, row, bases in _rows(data, bounds):
                found = {(b[0], row[b[3] : b[2]]) for b in bases}
                values.append(
                    [{"kind": k, "value": v.decode()} for k, v in sorted(found) if len(v) <= EXAMPLE_LONGEST]
                )
        kind = pa.list_(pa.struct([("kind", pa.string()), ("value", pa.string())]))
        return [pa.array(values, kind)]

    found = map_rows(df, [text], "found array<struct<kind string, value string>>", run, keep=[])
    values = kept(found.select(F.inline("found")).distinct(), "credentials")
    counts = {r["kind"]: r["n"] for r in values.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0.0)
    for kind, n in counts.items():
        share = F.when(F.col("kind") == kind, min(1.0, examples / n)).otherwise(share)
    drawn = values.filter(uniform("value") < share).limit(2 * examples * len(ORDER)).collect()
    by_kind: dict[str, list[bytes]] = {}
    for kind, value in sorted(drawn):
        by_kind.setdefault(kind, []).append(value.encode())
    formats: dict[str, Automaton | Background] = {kind: Automaton(sample) for kind, sample in by_kind.items()}
    if formats:
        formats[OTHER] = Background([*_others(df, text, dict(formats), examples), PLAIN])
    return formats


def _likely(tokens: Tokens, formats: dict, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """For each token by how much a format beats the background, or -inf, and which."""
    best, which = np.full(len(tokens.starts), -np.inf), np.zeros(len(tokens.starts), int)
    if OTHER not in formats:
        return best, which
    for i, kind in enumerate(KINDS):
        if kind in formats:
            rows = formats[kind].reaching(tokens)
            score, mean = formats[kind].walk(tokens.take(rows))
            better = (mean >= formats[kind].low) & (score > best[rows])
            best[rows[better]], which[rows[better]] = score[better], i
    rows = np.flatnonzero(best > -np.inf)
    best[rows] -= formats[OTHER].walk(tokens.take(rows))
    best[best < margin] = -np.inf
    # A wide run counts unless the runs inside fit better together.
    inside = np.zeros(len(best))
    inner = np.flatnonzero((tokens.parent >= 0) & (best > -np.inf))
    np.add.at(inside, tokens.parent[inner], best[inner])
    wide = best >= inside
    best[inner[wide[tokens.parent[inner]]]] = -np.inf
    best[(tokens.parent < 0) & ~wide] = -np.inf
    return best, which


SPANS = "spans array<struct<kind string, start int, end int, score double>>"


def _found(texts: pa.Array, formats: dict, margin: float) -> list[list[tuple]]:
    """Spans (kind, start, end, score) of each text, in code points."""
    spans: list[list[tuple]] = []
    for _, data, bounds in _parts(texts):
        part = [[(k, b + s, b + e, None) for k, s, e, _ in bases] for _, b, _, bases in _rows(data, bounds)]
        if OTHER in formats:
            tokens = Tokens.of(data, bounds, [x[1:3] for found in part for x in found])
            best, which = _likely(tokens, formats, margin)
            hits = np.flatnonzero(best > -np.inf)
            owners = np.searchsorted(bounds, tokens.starts[hits], "right") - 1
            for i, k in zip(owners.tolist(), hits.tolist()):
                part[i].append((LIKE[which[k]], int(tokens.starts[k]), int(tokens.ends[k]), float(best[k])))
        for i, found in enumerate(part):
            if found:
                low = bounds[i]
                begins = (np.frombuffer(data[low : bounds[i + 1]], np.uint8) & 0xC0) != 0x80
                place = np.concatenate([[0], np.cumsum(begins)]).tolist()
                found = [(k, place[s - low], place[e - low], x) for k, s, e, x in found]
                part[i] = sorted(found, key=lambda x: (x[1], ORDER[x[0]], x[2]))
        spans += part
    return spans


def scan_secrets(
    df: DataFrame,
    formats: dict[str, Automaton],
    *,
    text: str = "text",
    margin: float = MARGIN,
    keep: list[str] | None = None,
) -> DataFrame:
    """Adds ``spans``: kind, start and end (code points, end exclusive) and score.

    Kinds ``assign``, ``access`` and ``hex`` are matches of the patterns, without a
    score; ``like_...`` are tokens that no pattern touches and that fit a learned
    format, with the log-likelihood by which they do. Tokens are all maximal runs of
    at least CANDIDATE_LEAST characters of ``[A-Za-z0-9+/_-]``, and of these with
    ``.`` and ``=``; of a run and those inside it what fits better is reported. Short
    ones seldom reach the margin. Spans come by start, then kind in that order.

    A null or empty text has no spans (an empty array). Texts are scanned whole.
    Rows are independent: repeated rows and null ids stay as they are, an empty
    table gives none, and a column already named ``spans`` is replaced.
    """

    def run(texts: pa.Array) -> list[pa.Array]:
        fields = [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]
        names = [f[0] for f in fields]
        found = [[dict(zip(names, s)) for s in spans] for spans in _found(texts, formats, margin)]
        return [pa.array(found, pa.list_(pa.struct(fields)))]

    return map_rows(df, [text], SPANS, run, keep=keep)


def mask_secrets(
    df: DataFrame,
    formats: dict[str, Automaton],
    *,
    text: str = "text",
    mask: str = "[secret]",
    margin: float = MARGIN,
) -> DataFrame:
    """``df`` with a mask in place of each span that :func:`scan_secrets` finds.

    Overlapping spans share one mask. Texts without spans, null ones among them, and
    all other columns stay as they are.
    """

    def run(texts: pa.Array) -> list[pa.Array]:
        out = texts.to_pylist()
        for i, found in enumerate(_found(texts, formats, margin)):
            if found:
                pieces, at = [], 0
                for _, start, end, _ in found:
                    if start >= at:
                        pieces += [out[i][at:start], mask]
                    at = max(at, end)
                out[i] = "".join([*pieces, out[i][at:]])
        return [pa.array(out, pa.string())]

    others = [c for c in df.columns if c != text]
    return map_rows(df, [text], f"`{text}` string", run, keep=others).select(*[F.col(f"`{c}`") for c in df.columns])
