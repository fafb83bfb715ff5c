"""File readers and writers: text, JSON, CSV, Parquet and ORC."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weft.sources.scratch import scratch_path


def read_lines(
    spark: SparkSession,
    path: str,
    *,
    whole: bool = False,
    line_sep: str | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """One row per line (or per file) in the column ``value``.

    Plain text splits at ``spark.sql.files.maxPartitionBytes``. Rows are moved
    for ``min_partitions`` only if the scan has fewer splits than that, as with
    one compressed file.
    """
    options = {"lineSep": line_sep} if line_sep else {}
    df = spark.read.text(path, wholetext=whole, **options)
    if min_partitions and df.rdd.getNumPartitions() < min_partitions:
        df = df.repartition(min_partitions)
    return df


def pair_lines(df: DataFrame, key: str, value: str) -> DataFrame:
    """``(key,value)`` text lines, the layout of a saved pair list. Null is ``null``.

    A line break would make two lines of one and a text ``null`` could not be told
    from null, so such a row fails.
    """

    def part(column: str) -> Column:
        text = F.col(column).cast("string")
        unclear = text.rlike("[\r\n]") | (text == "null")
        checked = F.when(unclear, F.raise_error(F.lit(f"{column} has no place on a line"))).otherwise(text)
        return F.coalesce(checked, F.lit("null"))

    line = F.concat(F.lit("("), part(key), F.lit(","), part(value), F.lit(")"))
    return df.select(line.alias("value"))


def write_partitioned(df: DataFrame, path: str, by: str, *, mode: str = "error") -> None:
    """One directory per value of ``by``; null goes to the default partition.

    The rebalance hint gathers each value in few files, and the adaptive plan
    still splits a value that holds far more rows than the others.
    """
    df.hint("rebalance", by).write.mode(mode).partitionBy(by).parquet(path)


def write_range_layout(
    df: DataFrame, path: str, key: str, *, ties: Sequence[str] = (), mode: str = "error"
) -> None:
    """Files with disjoint, sorted key ranges, so that a range filter on ``key``
    skips files and row groups by their min/max statistics.

    With ``ties`` a key that has very many rows is spread over several files.
    """
    ranged = df.repartitionByRange(key, *ties).sortWithinPartitions(key)
    ranged.write.mode(mode).parquet(path)


def key_between(key: str | Column, low, high) -> Column:
    """Both ends included; pushed down to the scan."""
    return (F.col(key) if isinstance(key, str) else key).between(low, high)


def write_indexed(
    df: DataFrame, path: str, key: str, *, stride: int = 10_000, error: float = 0.01, mode: str = "error"
) -> None:
    """ORC files with a Bloom filter on ``key`` for every ``stride`` rows.

    A look-up by key then skips runs of rows that cannot hold it, also where the rows are
    laid out by something else. ``error`` is the share of runs read in vain.
    """
    options = {
        "orc.bloom.filter.columns": key,
        "orc.bloom.filter.fpp": error,
        "orc.row.index.stride": stride,
    }
    df.write.mode(mode).options(**options).orc(path)


def look_up(
    stored: DataFrame, key: str, wanted: DataFrame, *, column: str | None = None, most: int = 10_000
) -> DataFrame:
    """Rows of ``stored``, a scan of files or of a table, whose ``key`` is one of those in
    ``wanted``; ``column`` names them there (default: ``key``). A null key is none.

    Up to ``most`` different keys are brought to the driver and become a filter on the
    scan, which then reads only the runs of rows, files or buckets that may hold them.
    More keys than that would touch most runs anyway and are joined instead.
    """
    kind = stored.schema[key].dataType
    keys = wanted.select(F.col(f"`{column or key}`").cast(kind).alias(key)).distinct().na.drop()
    some = [r[0] for r in keys.limit(most + 1).collect()]
    if len(some) > most:
        return stored.join(keys, key, "left_semi").select(stored.columns)
    return stored.filter(F.col(f"`{key}`").isin(some)) if some else stored.limit(0)


def write_keyed(parts: dict[int, DataFrame], root: str, key: str = "key") -> None:
    """Write each frame into its own ``key=N`` directory below ``root``."""
    for number, df in parts.items():
        df.write.parquet(f"{root}/{key}={number}")


def merged_schema_read(spark: SparkSession, root: str, key: str = "key") -> DataFrame:
    """Read sibling ``key=N`` directories whose files differ in columns.

    A manifest beside the data, ``_schema``, holds the merged schema and the directories
    it covers. Only directories that it does not name are asked for their schema, one
    file of each; if there are any, a new version of the manifest is added, so no later
    read opens them again. A column is as wide as its widest type.
    """
    files = spark.read.schema(f"{key} int").parquet(root).inputFiles()
    found = {name for f in files for name in f.split("/") if name.startswith(f"{key}=")}
    versions = _manifests(spark, root)
    newest = max(versions, key=lambda v: v["version"], default={"version": 0, "fields": [], "directories": []})
    schema = T.StructType.fromJson({"type": "struct", "fields": newest["fields"]})
    fresh = sorted(found - set(newest["directories"]))
    for directory in fresh:
        schema = merged(schema, spark.read.parquet(f"{root}/{directory}").schema)
    if fresh:
        newest = {
            "version": newest["version"] + 1,
            "fields": schema.jsonValue()["fields"],
            "directories": sorted(found | set(newest["directories"])),
        }
        line = spark.createDataFrame([(json.dumps(newest),)], "value string")
        line.coalesce(1).write.mode("append").text(f"{root}/_schema")
    whole = T.StructType([*schema.fields, T.StructField(key, T.IntegerType())])
    return spark.read.schema(whole).parquet(root)


def _manifests(spark: SparkSession, root: str) -> list[dict]:
    """All versions of the manifest: one short line each."""
    try:
        return [json.loads(r[0]) for r in spark.read.text(f"{root}/_schema").collect()]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


#: Types by width: one that comes later holds all values of those before it.
WIDTHS = [
    [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()],
    [T.FloatType(), T.DoubleType()],
    [T.ByteType(), T.ShortType(), T.IntegerType(), T.DoubleType()],
]


def merged(one: T.StructType, other: T.StructType) -> T.StructType:
    """The columns of both, those of ``one`` first, each as wide as the wider type.

    Types without a wider one in common raise.
    """
    fields = {f.name: f.dataType for f in one.fields}
    for field in other.fields:
        fields[field.name] = _wider(fields.get(field.name, field.dataType), field.dataType, field.name)
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _wider(one: T.DataType, other: T.DataType, name: str) -> T.DataType:
    if one == other:
        return one
    if isinstance(one, T.StructType) and isinstance(other, T.StructType):
        return merged(one, other)
    if isinstance(one, T.ArrayType) and isinstance(other, T.ArrayType):
        return T.ArrayType(_wider(one.elementType, other.elementType, name))
    for kinds in WIDTHS:
        if one in kinds and other in kinds:
            return kinds[max(kinds.index(one), kinds.index(other))]
    raise ValueError(f"column {name} is {one.simpleString()} here and {other.simpleString()} there")


#: Quotes, blanks at the ends, nulls and empty texts survive with these.
CSV_WHOLE = {
    "quote": '"',
    "escape": '"',
    "quoteAll": True,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "nullValue": "\\N",
    "emptyValue": "",
}
#: What stands for what in a CSV text. Each backslash begins one of these, so a record
#: is one line, files can be split, and no text looks like the mark of a null.
CSV_ESCAPES = {"\\": "\\b", "\n": "\\n", "\r": "\\r"}


def round_trip(df: DataFrame, fmt: str | None = None, **options) -> DataFrame:
    """Write ``df`` to scratch and read it back with the same options and schema.

    Without ``fmt`` the session's default source is used, as by a plain
    ``save``/``load``. CSV is written and read with CSV_WHOLE beneath ``options``, and
    texts are escaped (see ``csv_escaped``), so that the same rows come back; nested
    columns, which CSV cannot hold, are refused.
    """
    spark = df.sparkSession
    path = scratch_path(spark, fmt or "default")
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if fmt == "csv":
        nested = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))]
        if nested:
            raise ValueError(f"CSV cannot hold the columns {nested}")
        options = {**CSV_WHOLE, **options}
        written = df.withColumns({c: csv_escaped(c) for c in texts})
    else:
        written = df
    writer, reader = written.write, spark.read.schema(df.schema)
    if fmt:
        writer, reader = writer.format(fmt), reader.format(fmt)
    writer.options(**options).save(path)
    read = reader.options(**options).load(path)
    return read.withColumns({c: csv_plain(c) for c in texts}) if fmt == "csv" else read


def csv_escaped(column: str) -> Column:
    """The text with CSV_ESCAPES."""
    text = F.col(f"`{column}`")
    for plain, mark in CSV_ESCAPES.items():
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return text


def csv_plain(column: str) -> Column:
    """Undoes :func:`csv_escaped`; the backslash comes last, as it begins the others."""
    text = F.col(f"`{column}`")
    for plain, mark in reversed(CSV_ESCAPES.items()):
        text = F.replace(text, F.lit(mark), F.lit(plain))
    return text
