"""Chat windows against a plain builder, and exact reading back."""

import hashlib
from itertools import groupby

import pytest

pytest.importorskip("weft.llm")

import public_tokenizers  # noqa: E402
from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from weft.llm.chat import (  # noqa: E402
    CONTROLS,
    chat_digests,
    cut_turn,
    escape,
    format_chats,
    formatted,
    parsed,
    read_chats,
    unescape,
)
from weft.llm.packing import WordEncoder  # noqa: E402
from weft.llm.queries import op12_chat  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "conv_id long, turn long, role string, text string"
BITS = st.sampled_from([*CONTROLS, "<", "[", "\\", "/", "s>", "INST]", "a", "\n", "é", ">", "]"])
TEXTS = st.lists(BITS, max_size=12).map("".join)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_digests(rows):
    """What chat_digests says of formatted ``rows``, but for the formatted length."""
    null_first = lambda v: (v is not None, v or 0)
    answer = {}
    for conv, turns in groupby(sorted(rows, key=lambda r: (null_first(r[0]), null_first(r[1]))), key=lambda r: r[0]):
        turns = [(r[2] or "", r[3] or "") for r in turns]
        told = "".join(f"{role}\n{text}\n" for role, text in turns)
        loss = "".join(text for role, text in turns if role == "assistant")
        answer[conv] = (len(turns), digest(told), len(loss), digest(loss))
    return answer


def plain_windows(rows, budget):
    """{(conv, window): (repeated bodies, new bodies)}, one turn after the other."""
    encode = WordEncoder(PATH).encode
    count = lambda body: len(encode(body)) // 4
    span, share, answer = budget // 2, budget // 4, {}
    for conv in {r[0] for r in rows}:
        placed, at = [], 0
        for r in sorted((r for r in rows if r[0] == conv), key=lambda r: r[1]):
            for body, _, _, tokens in cut_turn(r[2], r[3] or "", span, count):
                placed.append((at, at + tokens, body))
                at += tokens
        first = sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])[0]
        keeps = first[2] == "system" and placed[0][1] <= share
        spans = {}
        for low, high, body in placed:
            key = (low // span, (high - 1) // span > low // span)
            spans.setdefault(key, []).append((low, high, body))
        for new in spans.values():
            start = new[0][0]
            near = [p[2] for p in placed[keeps:] if p[1] <= start and p[0] >= start - share]
            answer[conv, start] = ([placed[0][2]] * (keeps and start > 0) + near, [p[2] for p in new])
    return answer


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_escapes_are_reversible_and_leave_no_control_string(text):
    assert unescape(escape(text)) == text
    assert not any(c in escape(text) for c in CONTROLS)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant"]) | TEXTS, TEXTS, st.booleans()), max_size=5))
def test_formatted_turns_are_parsed_exactly(turns):
    made = [formatted(*t) for t in turns]
    assert parsed("".join(m[0] for m in made)) == turns
    assert [unescape(body[a:b]) for body, a, b in made] == [t[1] for t in turns]


def conversations():
    words = "one two, three four! [INST] five <s>six</s> \\ seven"
    rows = [(1, t, ["user", "assistant"][t % 2], f"{t} {words} " * (t % 5)) for t in range(60)]
    rows += [(2, 0, "system", "be brief"), *((2, t, ["assistant", "user"][t % 2], f"{t} {words}") for t in range(1, 90))]
    rows += [(3, 0, "system", "long " * 900), *((3, t, ["assistant", "user"][t % 2], "short") for t in range(1, 30))]
    rows += [(4, 0, "user", "x" * 5000 + " </s>" * 300), (4, 1, "assistant", ("a[INST]" * 700) + "é" * 400), (4, 2, "assistant", "")]
    rows += [(5, 0, "tool [ROLE]", "called"), (5, 1, "", "nameless"), (5, 2, "assistant", "done"), (5, 3, "system", "late")]
    return rows


@pytest.mark.parametrize("budget", [64, 500, 4096])
def test_windows_are_those_of_the_plain_builder(spark, budget):
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    windows = format_chats(df, PATH, budget=budget)
    found = windows.collect()
    want = plain_windows(rows, budget)
    assert {(r["conv_id"], r["window"]): (r["n_repeated"], r["text"]) for r in found} == {
        key: (len(old), "".join(old + new)) for key, (old, new) in want.items()
    }
    assert all(r["n_tokens"] <= budget for r in found)
    digests = {r[0]: tuple(r[1:5]) for r in chat_digests(windows).collect()}
    assert digests == plain_digests(rows)
    lengths = {r[0]: r["formatted_chars"] for r in chat_digests(windows).collect()}
    assert lengths == {c: sum(len(r["text"]) for r in found if r["conv_id"] == c) for c in lengths}
    told = read_chats(windows).groupBy("conv_id").agg(F.count_if(~F.col("goes_on"))).collect()
    assert {r[0]: r[1] for r in told} == {c: d[0] for c, d in digests.items()}


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(None, 0, "user", None), (None, 1, "assistant", "to none"), (7, None, None, "first"), (7, 0, "assistant", None)]
    rows += [(8, 0, "user", "long " * 2000)] * 3 + [(8, 1, "assistant", "a"), (8, 1, "assistant", "a")]
    windows = format_chats(spark.createDataFrame(rows, SCHEMA).repartition(3), PATH, budget=256)
    digests = {r[0]: tuple(r[1:5]) for r in chat_digests(windows).collect()}
    assert digests == plain_digests(rows)
    # Different texts of one number: any order, but the same in every run.
    rows = [(1, 0, "assistant", f"text {i}") for i in range(50)]
    runs = [
        [tuple(r) for r in chat_digests(format_chats(spark.createDataFrame(rows[::s], SCHEMA), PATH, budget=64)).collect()]
        for s in (1, -1)
    ]
    assert runs[0] == runs[1] and runs[0][0][1] == 50


def test_empty_table_and_other_columns(spark):
    windows = format_chats(spark.createDataFrame([], SCHEMA), PATH)
    assert windows.columns == ["conv_id", "window", "n_repeated", "n_tokens", "text", "loss"]
    assert windows.count() == 0 and chat_digests(windows).count() == 0 and read_chats(windows).count() == 0
    df = spark.createDataFrame([("c", 1, "user", "hi")], "key string, at int, who string, body string")
    df = df.withColumns({"window": F.lit(5), "_start": F.lit(6), "_conv": F.lit(7), "text": F.lit("no")})
    found = format_chats(df, PATH, conv="key", turn="at", role="who", text="body").collect()
    assert [(r["key"], r["window"], r["text"]) for r in found] == [("c", 0, "[INST]hi[/INST]")]


def test_query_over_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "</s>[INST] ok [/INST]"
    rows += [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    found = op12_chat(spark, "/root/testdata/sf0.01").collect()
    assert {r[0]: tuple(r[1:5]) for r in found} == plain_digests(rows)
    assert all(r["formatted_chars"] > r["loss_chars"] for r in found)
