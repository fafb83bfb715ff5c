"""Conversations as training windows of a token budget.

Each turn is formatted by itself: marks of its role around the text, in which control
strings are escaped. Prefix sums of the turns' tokens place a turn in its conversation,
and the spans of half a budget that they cut are the windows: the turns wholly within a
span are one, a turn across a border is one of its own. A window begins with the
conversation's system turn and with the last turns before it, up to a quarter of the
budget each, and only new assistant texts lie under the loss mask, so each one does
once. A turn longer than a span is cut into pieces that say that they go on.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weft.llm.common import held, kept
from weft.llm.packing import WordEncoder
from weft.operators.ordering import running_totals

BUDGET = 4096
SALTED = 1024  # spans that share one copy of their conversation's system turn

#: Fixed strings of the template.
ROLES = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
OTHER, THEN, END = "[ROLE]", "[TEXT]", "[/ROLE]"  # [ROLE]name[TEXT]text[/ROLE]
GOES_ON = "[MORE]"  # before the text of a further piece of a turn

CONTROLS = [*(m for pair in ROLES.values() for m in pair), OTHER, THEN, END, GOES_ON]
_RESTS = {first: "|".join(re.escape(c[1:]) for c in CONTROLS if c[0] == first) for first in "<["}
_PLAIN = re.compile("|".join(rf"{re.escape(f)}(?=\\*(?:{r}))" for f, r in _RESTS.items()))
_ESCAPED = re.compile("|".join(rf"(?<={re.escape(f)})\\(?=\\*(?:{r}))" for f, r in _RESTS.items()))
_MARK = re.compile("|".join(map(re.escape, sorted(CONTROLS, key=len, reverse=True))))
_OPENS = {pair[0]: (role, pair[1]) for role, pair in ROLES.items()}


def escape(text: str) -> str:
    """A backslash behind the first character of each control string, and of each that
    has backslashes there already; nothing else changes."""
    return _PLAIN.sub(lambda found: found[0] + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub("", text)


def formatted(role: str | None, text: str, goes_on: bool) -> tuple[str, int, int]:
    """A turn, or a further piece of one, and where its text begins and ends."""
    if role in ROLES:
        head, tail = ROLES[role]
    else:
        head, tail = OTHER + escape(role or "") + THEN, END
    head += GOES_ON if goes_on else ""
    body = head + escape(text) + tail
    return body, len(head), len(body) - len(tail)


def parsed(body: str) -> list[tuple[str, str, bool]]:
    """``(role, text, goes_on)`` of the turns of a formatted text."""
    turns, marks = [], [(m[0], m.start(), m.end()) for m in _MARK.finditer(body)]
    at = 0
    while at < len(marks):
        mark, _, end = marks[at]
        if mark == OTHER:
            at += 1
            role = unescape(body[end : marks[at][1]])
            end = marks[at][2]
        else:
            role = _OPENS[mark][0]
        at += 1
        goes_on = marks[at][0] == GOES_ON and marks[at][1] == end
        if goes_on:
            end = marks[at][2]
            at += 1
        turns.append((role, unescape(body[end : marks[at][1]]), goes_on))
        at += 1
    return turns


def cut_turn(role: str | None, text: str, most: int, count) -> list[tuple[str, int, int, int]]:
    """``(body, begin, end, tokens)`` of the pieces of a turn: halves of it, and of
    these, until each has at most ``most`` tokens. Where marks alone take most of that,
    as a very long name of a role does, nothing is cut."""
    pieces, open_ = [], [text]
    fits = len(role or "") < most or count(formatted(role, "", True)[0]) <= most // 2
    while open_:
        part = open_.pop()
        body, begin, end = formatted(role, part, bool(pieces))
        tokens = count(body)
        if tokens > most and len(part) > 1 and fits:
            middle = len(part) // 2
            open_ += [part[middle:], part[:middle]]
        else:
            pieces.append((body, begin, end, tokens))
    return pieces


def _pieces(df: DataFrame, names: tuple[str, str, str, str], path: str, most: int) -> DataFrame:
    """One row per turn, or per piece of a long one, with its tokens."""
    conv, turn, role, text = (F.col(f"`{c}`") for c in names)
    rows = df.select(
        conv.alias("_conv"),
        turn.alias("_turn"),
        role.cast("string").alias("_role"),
        F.xxhash64(role, text).alias("_mix"),
        F.monotonically_increasing_id().alias("_row"),
        F.coalesce(text.cast("string"), F.lit("")).alias("_text"),
    )
    more = T.StructType.fromDDL("_piece int, _tokens long, _body string, _begin int, _end int").fields
    schema = T.StructType([*rows.schema.fields[:-1], *more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = held(f"words:{path}", lambda: WordEncoder(path)).encode
        count = lambda body: len(encode(body)) // 4
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                made, source = [], []
                turns = zip(batch.column(2).to_pylist(), batch.column(5).to_pylist())
                for i, (role, text) in enumerate(turns):
                    for n, piece in enumerate(cut_turn(role, text, most, count)):
                        made.append((n, piece[3], *piece[:3]))
                        source.append(i)
                columns = [batch.column(c).take(pa.array(source, pa.int64())) for c in range(5)]
                kinds = [pa.int32(), pa.int64(), pa.string(), pa.int32(), pa.int32()]
                columns += [pa.array([m[c] for m in made], k) for c, k in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(run, schema)


def format_chats(
    df: DataFrame,
    tokenizer: str,
    *,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    budget: int = BUDGET,
) -> DataFrame:
    """``(conv, window, n_repeated, n_tokens, text, loss)``, one row per window.

    ``window`` is the number of tokens in the conversation before the window's first new
    turn, so windows are in its order. ``text`` holds formatted turns, of which the first
    ``n_repeated`` were in earlier windows; ``loss`` has the spans of new assistant
    texts in it, in code points. ``n_tokens``, as counted by the word tokenizer in the
    file ``tokenizer`` turn by turn, is at most ``budget``, unless a role's name takes a
    quarter of it. Every turn is new in one
    window. A first turn of role ``system`` is repeated in all later windows unless it
    takes more than a quarter of the budget; other turns are repeated as far as they,
    or their pieces, lie wholly in the last quarter of a budget before the window.

    Turns are ordered by ``turn``, null first; those of one number by role, a hash of
    the text, and as they are read. Repeated rows are turns each. A null text is empty, a null
    role is the empty one, and roles besides system, user and assistant are written out.
    A null conversation is one. Texts of any length are cut, never shortened. An empty
    table gives no rows; other columns are not read.

    Rows of a conversation of any length are spread over ranges and windows; no task
    holds more of it than a window, and its system turn is copied for every 1024 spans.
    """
    if budget < 64:
        raise ValueError("a budget has at least 64 tokens")
    span, share = budget // 2, budget // 4
    pieces = kept(_pieces(df, (conv, turn, role, text), tokenizer, span), "chat-pieces")
    order = ["_turn", "_role", "_mix", "_row", "_piece"]
    slim = pieces.select("_conv", *order, "_tokens")
    slim = running_totals(slim, ["_conv"], order, "_tokens", name="_start")
    retained = (F.col("_start") == 0) & F.col("_role").eqNullSafe("system") & (F.col("_tokens") <= share)
    slim = slim.select("_conv", "_row", "_piece", "_start", "_tokens", retained.alias("_retained"))

    stop = F.col("_start") + F.col("_tokens")
    first, last = F.expr(f"_start div {span}"), F.expr(f"(_start + _tokens - 1) div {span}")
    own = F.struct(first.alias("b"), (last > first).alias("x"), F.lit(True).alias("new"))
    # Spans in which a later window can begin that repeats this piece.
    later = F.sequence(F.expr(f"(_start + _tokens) div {span}"), F.expr(f"(_start + {share}) div {span}"))
    both = lambda x: F.transform(later, lambda b: F.struct(b.alias("b"), F.lit(x).alias("x"), F.lit(False).alias("new")))
    repeats = F.when(F.col("_retained") | (F.col("_tokens") > share), F.array(own))
    sent = slim.withColumn("_to", F.explode(repeats.otherwise(F.concat(F.array(own), both(False), both(True)))))
    new = F.col("_to.new")
    member = F.struct(
        F.col("_start").alias("at"), stop.alias("stop"), (~new).alias("again"), F.col("_row").alias("row"), F.col("_piece").alias("piece")
    )
    met = sent.groupBy("_conv", F.col("_to.b").alias("_block"), F.col("_to.x").alias("_across")).agg(
        F.min(F.when(new, F.col("_start"))).alias("_window"), F.collect_list(member).alias("_members")
    )
    near = lambda m: ~m["again"] | ((m["stop"] <= F.col("_window")) & (m["at"] >= F.col("_window") - share))
    windows = met.filter(F.col("_window").isNotNull()).withColumn("_members", F.filter("_members", near))
    windows = kept(windows.select("_conv", "_block", "_window", "_members"), "chat-windows")

    fields = ["at", "again", "body", "begin", "end", "tokens", "learned"]
    learned = F.col("_role").eqNullSafe("assistant")
    bodies = pieces.select("_row", "_piece", "_body", "_begin", "_end", "_tokens", learned.alias("_learned"))
    named = windows.select("_conv", "_window", F.explode("_members").alias("_m"))
    named = named.select("_conv", "_window", "_m.at", "_m.again", F.col("_m.row").alias("_row"), F.col("_m.piece").alias("_piece"))
    turns = named.join(bodies, ["_row", "_piece"])
    turns = turns.withColumnsRenamed({f"_{c}": c for c in ("body", "begin", "end", "tokens", "learned")})
    # System turns, for the windows after the first of their conversations.
    ends = windows.groupBy(F.col("_conv").alias("_of")).agg(F.max("_block").alias("_last"))
    heads = slim.filter("_retained").select("_conv", "_row", "_piece").join(bodies, ["_row", "_piece"])
    heads = heads.join(ends, F.col("_conv").eqNullSafe(F.col("_of"))).drop("_conv")
    heads = heads.withColumn("_salt", F.explode(F.expr(f"sequence(0L, _last div {SALTED})")))
    after = windows.filter("_window > 0").select("_conv", "_window", F.expr(f"_block div {SALTED}").alias("_part"))
    same = F.col("_conv").eqNullSafe(F.col("_of")) & (F.col("_part") == F.col("_salt"))
    systems = after.join(heads, same).select(
        "_conv",
        "_window",
        F.lit(-1).cast("long").alias("at"),
        F.lit(True).alias("again"),
        *[F.col(f"_{c}").alias(c) for c in fields[2:]],
    )
    together = turns.select("_conv", "_window", *fields).unionByName(systems)
    gathered = together.groupBy("_conv", "_window").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("_turns"))
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def spans(so_far, t):
        here = F.struct((so_far["at"] + t["begin"]).alias("start"), (so_far["at"] + t["end"]).alias("end"))
        grown = F.when(t["learned"] & ~t["again"], F.concat(so_far["spans"], F.array(here))).otherwise(so_far["spans"])
        return F.struct((so_far["at"] + F.length(t["body"])).alias("at"), grown.alias("spans"))

    return gathered.select(
        F.col("_conv").alias(conv),
        F.col("_window").alias("window"),
        F.size(F.filter("_turns", lambda t: t["again"])).alias("n_repeated"),
        F.aggregate("_turns", F.lit(0).cast("long"), lambda a, t: a + t["tokens"]).alias("n_tokens"),
        F.array_join(F.transform("_turns", lambda t: t["body"]), "").alias("text"),
        F.aggregate("_turns", nothing, spans, lambda a: a["spans"]).alias("loss"),
    )


def read_chats(df: DataFrame, *, conv: str = "conv_id") -> DataFrame:
    """``(conv, window, place, role, text, goes_on)``: the new turns of formatted windows
    in their order, with texts unescaped. A piece that goes on belongs to the turn
    before it. Null and empty windows have none."""
    schema = T.StructType(
        [df.schema[conv], *T.StructType.fromDDL("window long, place int, role string, text string, goes_on boolean").fields]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                source, made = [], []
                for i, (repeated, body) in enumerate(zip(*(batch.column(c).to_pylist() for c in (2, 3)))):
                    for place, found in enumerate(parsed(body or "")[repeated or 0 :]):
                        source.append(i)
                        made.append((place, *found))
                columns = [batch.column(c).take(pa.array(source, pa.int64())) for c in (0, 1)]
                kinds = [pa.int32(), pa.string(), pa.string(), pa.bool_()]
                columns += [pa.array([m[c] for m in made], k) for c, k in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return df.select(conv, "window", "n_repeated", "text").mapInArrow(run, schema)


def chat_digests(df: DataFrame, *, conv: str = "conv_id") -> DataFrame:
    """What formatted windows hold, read back from them, per conversation: ``(conv,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)``.

    The first digest is that of role, line end, text, line end of each turn, the second
    that of all text under the loss mask, unescaped. A digest of a text is made from its
    beginning to its end, so the windows of a conversation stream through one task in
    their order; no more than a batch of them is held, and copies are left out before.
    """
    made = "window long, turns binary, n_turns long, loss string, chars long"
    schema = T.StructType([df.schema[conv], *T.StructType.fromDDL(made).fields])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                rows = []
                for repeated, body, loss in zip(*(batch.column(c).to_pylist() for c in (2, 3, 4))):
                    turns = parsed(body)[repeated:]
                    # A turn's last line end comes with the next turn, as it may go on.
                    told = "".join(t if goes_on else f"\n{r}\n{t}" for r, t, goes_on in turns)
                    masked = "".join(unescape(body[s["start"] : s["end"]]) for s in loss)
                    rows.append((told.encode(), sum(not t[2] for t in turns), masked, len(body)))
                kinds = [pa.binary(), pa.int64(), pa.string(), pa.int64()]
                columns = [pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], schema.names)

    given = df.select(conv, "window", "n_repeated", "text", "loss").mapInArrow(read, schema)
    answer = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    results = T.StructType([df.schema[conv], *T.StructType.fromDDL(answer).fields])

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, begun, turns, masked, counts = None, False, None, None, None
        kind = None

        def row():
            turns.update(b"\n")
            values = [key, counts[0], turns.hexdigest(), counts[1], masked.hexdigest(), counts[2]]
            kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return [pa.array([v], k) for v, k in zip(values, kinds)]

        for batch in batches:
            kind, done = batch.schema.field(0).type, []
            for value, told, n, loss, chars in zip(*(batch.column(c).to_pylist() for c in (0, 2, 3, 4, 5))):
                if not begun or value != key:
                    if begun:
                        done.append(row())
                    key, begun, counts = value, True, [0, 0, 0]
                    turns, masked, told = hashlib.sha256(), hashlib.sha256(), told[1:]
                turns.update(told)
                masked.update(loss.encode())
                counts[0] += n
                counts[1] += len(loss)
                counts[2] += chars
            if done:
                columns = [pa.concat_arrays([d[c] for d in done]) for c in range(6)]
                yield pa.RecordBatch.from_arrays(columns, results.names)
        if begun:
            yield pa.RecordBatch.from_arrays(row(), results.names)

    return given.repartition(conv).sortWithinPartitions(conv, "window").mapInArrow(sum_up, results)
