"""Word and line queries over document texts."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from weft.functions.text import (
    characters,
    clipped,
    lines,
    parse_delimited,
    word_rows,
    words,
)
from weft.operators import rows
from weft.operators.grouping import count_by_key
from weft.operators.ordering import top
from weft.plans.registry import query
from weft.sources.files import pair_lines, read_lines
from weft.sources.scratch import scratch_path
from weft.sources.tables import widened

LINES = "(SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)"
WORD_LIST = (
    "CASE WHEN regexp_full_match(line, ' +') THEN [] ELSE string_split(rtrim(line, ' '), ' ') END"
)
WORDS = f"(SELECT doc_id, unnest({WORD_LIST}) AS word FROM {LINES})"
WORD_COUNT = f"len({WORD_LIST})"


def _lines(t, *keep):
    return lines(widened(t.documents.select("text", *keep)), "text", *keep)


@query("A15 T02 T03", f"SELECT word, count(*) AS n FROM {WORDS} GROUP BY word")
def word_count(t):
    return count_by_key(word_rows(_lines(t), "line"), "word")


@query(
    "S01 S02 S03 S17 A15",
    f"SELECT '(' || word || ',' || n || ')' AS value FROM "
    f"(SELECT word, count(*) AS n FROM {WORDS} GROUP BY word)",
)
def text_file_word_count(t):
    """From text files to text files, as a job without tables would run."""
    source, result = scratch_path(t.spark, "lines"), scratch_path(t.spark, "counts")
    lines(t.documents, "text", name="value").write.option("lineSep", "\n").text(source)
    cores = t.spark.sparkContext.defaultParallelism
    text = read_lines(t.spark, source, line_sep="\n", min_partitions=cores)
    counts = count_by_key(word_rows(text, "value"), "word")
    pair_lines(counts, "word", "n").write.option("lineSep", "\n").text(result)
    return read_lines(t.spark, result, line_sep="\n")


@query(
    "A15 O02 O03",
    f"SELECT word, count(*) AS n FROM {WORDS} GROUP BY word ORDER BY n DESC, word LIMIT 20",
)
def word_count_top(t):
    return top(word_count(t), 20, "n", ties=["word"])


@query("A22", f"SELECT word, count(*) AS n, max(doc_id) AS last_doc FROM {WORDS} GROUP BY word")
def reduce_groups(t):
    pairs = word_rows(_lines(t, "doc_id"), "line", "doc_id")
    return pairs.groupBy("word").agg(
        F.sum(F.lit(1).cast("long")).alias("n"), F.max("doc_id").alias("last_doc")
    )


@query("A16 X08", f"SELECT count(*) AS n FROM {WORDS}")
def word_total(t):
    sizes = F.size(words("line")).cast("long")
    return _lines(t).agg(F.sum(sizes).alias("n"))


@query("S01 A01", f"SELECT count(*) AS n FROM {LINES}")
def line_count(t):
    return lines(t.documents, "text").agg(F.count(F.lit(1)).alias("n"))


@query("A17", f"SELECT line, count(*) AS n FROM {LINES} GROUP BY line")
def line_frequency(t):
    return count_by_key(_lines(t), "line")


@query("X08", f"SELECT doc_id, line, CAST({WORD_COUNT} AS INT) AS n FROM {LINES}")
def words_per_line(t):
    return _lines(t, "doc_id").select(
        "doc_id", "line", F.size(words("line")).alias("n")
    )


@query("A18", f"SELECT CAST(max({WORD_COUNT}) AS INT) AS n FROM {LINES}")
def words_per_line_max(t):
    return _lines(t).agg(F.max(F.size(words("line"))).alias("n"))


@query(
    "A19",
    f"SELECT doc_id, line, CAST({WORD_COUNT} AS INT) AS n FROM {LINES} "
    "ORDER BY n DESC, doc_id, line LIMIT 1",
)
def longest_line(t):
    return top(words_per_line(t), 1, "n", ties=["doc_id", "line"])


@query("P06", f"SELECT doc_id, line FROM {LINES} WHERE contains(line, 'the')")
def lines_containing(t):
    # The document test is pushed to the scan and skips documents without a hit.
    hits = t.documents.filter(F.col("text").contains("the"))
    return lines(hits, "text", "doc_id").filter(F.col("line").contains("the"))


@query("T02", "SELECT p_partkey, unnest(string_split(p_name || 'a', '')) AS c FROM part")
def flatmap_chars(t):
    letters = characters(F.concat("p_name", F.lit("a")))
    return t.part.select("p_partkey", F.explode(letters).alias("c"))


@query(
    "O08",
    "SELECT CAST(page_id AS VARCHAR) AS page_id, CASE WHEN length(url) > 20 "
    "THEN substr(url, 1, 17) || '...' ELSE url END AS url, CASE WHEN length(html) > 20 "
    "THEN substr(html, 1, 17) || '...' ELSE html END AS html "
    "FROM (SELECT * FROM pages ORDER BY page_id LIMIT 20)",
)
def preview(t):
    return rows.preview(t.pages, 20, order=["page_id"])


@query(
    "O08",
    """
    WITH p AS (SELECT * FROM part ORDER BY p_partkey LIMIT 5),
    r AS (SELECT row_number() OVER (ORDER BY p_partkey) AS r, * FROM p)
    SELECT CAST(r AS INT) AS "row", field, value FROM (
      SELECT r, 'p_partkey' AS field, CAST(p_partkey AS VARCHAR) AS value FROM r
      UNION ALL SELECT r, 'p_name', p_name FROM r
      UNION ALL SELECT r, 'p_size', CAST(p_size AS VARCHAR) FROM r)
    """,
)
def preview_vertical(t):
    cells = t.part.select("p_partkey", "p_name", "p_size")
    return rows.preview(cells, 5, order=["p_partkey"], width=None, vertical=True)


@query(
    "O08 X02",
    "SELECT doc_id, length(text) AS n, CASE WHEN length(text) > 40 "
    "THEN substr(text, 1, 37) || '...' ELSE text END AS start FROM documents",
)
def text_lengths(t):
    return t.documents.select(
        "doc_id", F.length("text").cast("long").alias("n"), clipped("text", 40).alias("start")
    )


@query(
    "X04 S08",
    f"""
    SELECT trim(w[1]) AS name, CASE WHEN regexp_full_match(trim(w[2]), '[+-]?[0-9]{{1,18}}')
           THEN CAST(trim(w[2]) AS BIGINT) END AS number
    FROM (SELECT string_split(line, ' ') AS w FROM {LINES})
    """,
)
def parse_line_lenient(t):
    pair = T.StructType(
        [T.StructField("name", T.StringType()), T.StructField("number", T.LongType())]
    )
    return parse_delimited(_lines(t), "line", pair, sep=" ", lenient=True)
