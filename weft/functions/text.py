"""Text columns, all inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(c: str | Column) -> Column:
    """Words of a line, cut at every single blank.

    Empty words at the end are dropped; leading and inner ones are kept. An
    empty line is one empty word and a line of blanks only has no word.
    """
    line = _col(c)
    kept = F.rtrim(line)
    blanks_only = (kept == "") & (line != "")
    return F.when(blanks_only, F.array().cast("array<string>")).otherwise(F.split(kept, " "))


def characters(c: str | Column) -> Column:
    return F.split(_col(c), "")


def lines(df: DataFrame, text: str, *keep: str, name: str = "line") -> DataFrame:
    """One row per line of a multi-line text column, with the ``keep`` columns."""
    return df.select(*keep, F.explode(F.split(text, "\n")).alias(name))


def word_rows(df: DataFrame, line: str, *keep: str, name: str = "word") -> DataFrame:
    return df.select(*keep, F.explode(words(line)).alias(name))


def labelled(**parts: str | Column) -> Column:
    """``name:value`` pieces joined by tabs; null if any value is null."""
    pieces = []
    for label, value in parts.items():
        lead = f"{label}:" if not pieces else f"\t{label}:"
        pieces += [F.lit(lead), _col(value).cast("string")]
    return F.concat(*pieces)


def json_object(**fields: str | Column) -> Column:
    """The row's fields as a JSON object; a null field is left out."""
    return F.to_json(F.struct(*[_col(c).alias(n) for n, c in fields.items()]))


def values_map(*columns: str) -> Column:
    """The named columns as a map from name to text; a null stays in the map."""
    pairs = [p for c in columns for p in (F.lit(c), F.col(c).cast("string"))]
    return F.create_map(*pairs)


def clipped(c: str | Column, width: int = 20) -> Column:
    """Strings over ``width`` characters are cut and end in three dots."""
    text = _col(c).cast("string")
    cut = F.substring(text, 1, width) if width < 4 else F.concat(
        F.substring(text, 1, width - 3), F.lit("...")
    )
    return F.when(F.length(text) > width, cut).otherwise(text)


def parse_delimited(
    df: DataFrame,
    line: str,
    schema: T.StructType,
    *,
    sep: str = ",",
    lenient: bool = False,
) -> DataFrame:
    """Typed columns from a delimited line.

    Fields are trimmed. A value that does not fit its type raises, or becomes
    null when ``lenient``; missing trailing fields are null when ``lenient`` and
    raise otherwise.
    """
    cells = F.split(line, "\\Q" + sep + "\\E", -1)
    columns = []
    for position, field in enumerate(schema.fields):
        cell = F.trim(F.get(cells, position) if lenient else cells[position])
        typed = cell.try_cast(field.dataType) if lenient else cell.cast(field.dataType)
        columns.append(typed.alias(field.name))
    return df.select(*columns)
