"""Reads what a plan does from its explain text."""

import contextlib
import io
import re


def explain(df, mode="formatted"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


def tree(df):
    """The operator tree only, without the details below it."""
    return explain(df).split("\n\n\n")[0]


def operators(df, name):
    return len(re.findall(rf"[\s-]{name}\b", tree(df)))


def exchanges(df):
    return operators(df, "Exchange")
