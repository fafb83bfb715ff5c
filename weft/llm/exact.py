"""Exact deduplication with keyed state that a stream keeps on disk.

A stream of arrivals (digest of the text, id, locator of the row) is aggregated per
digest in a RocksDB state store that is never expired: the state of a digest holds
the smallest id, its locator and the number of rows. The same state folder can take
up further arrivals later. Digests that were hit more than once are then checked on
the full bytes of their texts. Everything is DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.llm.common import SPACE, kept
from weft.sources.scratch import scratch_path

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Digests that are sent to all executors at most, some tens of megabytes.
HITS_SENT = 250_000


def normalised(text: str) -> Column:
    """The text with each run of white space as one blank; null is empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), f"{SPACE}+", " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


#: Plans in which each row is a row of a file of its own.
SCAN_NODES = {"Project", "Filter", "SubqueryAlias", "LogicalRelation"}


def _is_scan(df: DataFrame) -> bool:
    """Whether a row of ``df`` is a row of one file, found again by every pass."""
    node = df._jdf.queryExecution().analyzed()
    while True:
        if node.getClass().getSimpleName() not in SCAN_NODES or not node.deterministic():
            return False
        if node.children().isEmpty():
            break
        node = node.children().head()
    try:
        df.select("_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        return False
    roots = node.relation().location().rootPaths()
    return roots.distinct().size() == roots.size()


def placed(df: DataFrame, place: str = "_place") -> DataFrame:
    """``df`` with a name for each row, the same in all passes: file and row number,
    if the frame is a plain scan of files. Any other frame (with several rows from one
    of a file, or rows in an order that another run need not repeat) is written
    once with numbers, and read from there."""
    if _is_scan(df):
        return df.withColumn(place, F.concat_ws("#", "_metadata.file_path", "_metadata.row_index"))
    return kept(df.withColumn(place, F.monotonically_increasing_id().cast("string")), "placed")


def _rows(df: DataFrame, id: str, text: str, place: str, digest: Callable[[Column], Column]) -> DataFrame:
    """``(_id, _place, _text, _digest)``."""
    rows = df.select(F.col(id).alias("_id"), F.col(place).alias("_place"), normalised(text).alias("_text"))
    return rows.withColumn("_digest", digest(F.col("_text")))


def update_state(arrivals: str, state: str, df: DataFrame) -> DataFrame:
    """Takes the arrivals in the folder ``arrivals`` that are new to the ``state``
    folder into it, and returns the whole state: ``(_digest, _keep, _size)``.

    ``df`` gives the session and the schema. The stream runs once over what is
    there, with its own settings, in a session of its own.
    """
    spark = df.sparkSession
    session = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        session.conf.set(key, spark.conf.get(key))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    # Else each store, one for each partition, takes megabytes ahead of use.
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    stream = session.readStream.schema(df.schema).parquet(arrivals)
    # Null ids come last; the place settles which of several rows of one id it is.
    first = F.min(F.struct(F.col("_id").isNull().alias("_none"), "_id", "_place"))
    keyed = stream.groupBy("_digest").agg(first.alias("_keep"), F.count(F.lit(1)).alias("_size"))
    writer = keyed.writeStream.format("noop").outputMode("update").trigger(availableNow=True)
    writer.option("checkpointLocation", state).start().awaitTermination()
    values = spark.read.format("statestore").load(state)
    names = values.schema["value"].dataType.names
    return values.select(
        F.col("key._digest").alias("_digest"),
        F.col(f"value.`{names[0]}`").alias("_keep"),
        F.col(f"value.`{names[1]}`").alias("_size"),
    )


def exact_groups(
    df: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """``(id, keep_id, group_size, kept, text_sha256)``, one row per row of ``df``.

    Texts are equal if they are the same bytes once each run of white space is one
    blank; null is empty. Of equal texts the row with the smallest id stays, a null
    id being the largest, and of several rows with that id one. Texts of any length
    are compared whole. An empty table gives no rows; other columns are left out.
    """
    place = place_name(df)
    rows = placed(df.select(*dict.fromkeys((id, text))), place)
    return _decided(rows, id, text, place, digest).select(
        F.col("_id").alias(id), "keep_id", "group_size", "kept", "text_sha256"
    )


def place_name(df: DataFrame) -> str:
    """Longer than any column's name."""
    return "_" * (1 + max(map(len, df.columns), default=0)) + "place"


def _decided(df, id, text, place, digest) -> DataFrame:
    spark = df.sparkSession
    rows = _rows(df, id, text, place, digest)
    marks = rows.select("_id", "_place", "_digest", F.sha2(F.col("_text").cast("binary"), 256).alias("_sha"))
    if digest is sha256:
        marks = marks.drop("_sha")
    path = scratch_path(spark, "arrivals")
    marks.write.parquet(path)
    arrivals = spark.read.schema(marks.schema).parquet(path)
    state = kept(update_state(path, scratch_path(spark, "state"), arrivals), "state")
    # Full bytes of the hits. No group of copies gathers in a task, as the extremes of a
    # group combine before they move. Different texts of one digest are told apart by their
    # bytes; with SHA-256 there are none. Few digests of hits go to the rows; many would be
    # too much for an executor, so then the hits meet their rows by place.
    hit = state.filter("_size > 1").select("_digest")
    if hit.count() <= HITS_SENT:
        texts = rows.join(F.broadcast(hit), "_digest", "left_semi")
    else:
        hits = arrivals.join(hit, "_digest").select("_place", "_digest")
        texts = rows.select("_place", "_text").join(hits, "_place")
    extremes = texts.groupBy("_digest").agg(F.min("_text").alias("_low"), F.max("_text").alias("_high"))
    mixed = kept(extremes.filter("_low <> _high").select("_digest"), "mixed")
    sha = F.lower(F.hex("_digest")) if digest is sha256 else F.col("_sha")
    fields = [
        F.col("_id"),
        F.col("_place"),
        F.col("_keep._id").alias("keep_id"),
        F.col("_size").alias("group_size"),
        (F.col("_keep._place") == F.col("_place")).alias("kept"),
        sha.alias("text_sha256"),
    ]
    if mixed.isEmpty():
        return arrivals.join(state, "_digest").select(*fields)
    plain = arrivals.join(mixed, "_digest", "left_anti").join(state, "_digest").select(*fields)
    first = F.min(F.struct(F.col("_id").isNull().alias("_none"), "_id", "_place"))
    texts = rows.join(mixed, "_digest", "left_semi").withColumn("_sha", F.sha2(F.col("_text").cast("binary"), 256))
    groups = texts.groupBy("_digest", "_text").agg(first.alias("_keep"), F.count(F.lit(1)).alias("_size"))
    fields[-1] = F.col("_sha").alias("text_sha256")
    return plain.unionByName(texts.join(groups, ["_digest", "_text"]).select(*fields))


def drop_exact_copies(df: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with one row of each group of equal texts; see :func:`exact_groups`."""
    place = place_name(df)
    rows = placed(df, place)
    gone = _decided(rows, id, text, place, sha256).filter(~F.col("kept")).select(F.col("_place").alias(place))
    return rows.join(gone, place, "left_anti").select(df.columns)
