"""The table of registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from weft.sources.tables import load_table


class Tables:
    """Tables of one directory, as attributes: ``t.orders``."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory

    def __getattr__(self, name: str) -> DataFrame:
        return load_table(self.spark, self.directory, name)


def labelled_documents(t: Tables) -> DataFrame:
    """Documents with their labels, which are null for most.

    ``doc_id`` is the key of both tables, so a plain left join is even.
    """
    documents = t.documents.select("doc_id", "lang", "source")
    return documents.join(t.labels, "doc_id", "left")


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    body: Callable[[Tables], DataFrame]
    oracle: str | None

    def __call__(self, spark: SparkSession, directory: str) -> DataFrame:
        return self.body(Tables(spark, directory))


REGISTRY: dict[str, Query] = {}


def query(covers: str, oracle: str | None = None):
    """Register the function under its own name."""

    def add(body: Callable[[Tables], DataFrame]):
        name = body.__name__
        if name in REGISTRY:
            raise ValueError(f"{name} is registered twice")
        REGISTRY[name] = Query(name, tuple(covers.split()), body, oracle)
        return body

    return add
