"""From raw documents to packed training sequences, stage by stage.

Each stage takes (session, documents, table directory) and returns a frame, which is
written and read again for the next one. All but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.llm.common import kept
from weft.llm.exact import drop_exact_copies
from weft.llm.quality import score_quality
from weft.llm.queries import QUALITY_BOUND, packed, trained_quality
from weft.llm.secrets import learn_formats, mask_secrets
from weft.llm.simhash import drop_near_copies
from weft.sources.tables import widened


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    scored = score_quality(widened(docs), trained_quality(spark, sf_dir))
    return scored.filter(F.col("score") >= QUALITY_BOUND).select(docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates."""
    return drop_near_copies(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with found secrets masked and lengths counted anew."""
    masked = mask_secrets(docs, learn_formats(docs))
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens."""
    return packed(docs)


STAGES = [
    ("quality", quality),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("secrets", secrets),
    ("packing", packing),
]

#: Models and tokenizers are beyond SQL; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
