"""Every registered query against its SQL twin."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from weft.plans import REGISTRY
from weft.sources.tables import TABLES

DIRECTORY = os.environ.get("WEFT_TEST_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{DIRECTORY}/{name}.parquet')"
        )
    return connection


DUCK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
}


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)
    return [columns[i] for i in order], body


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_sql(spark, duck, name):
    df = queries()[name](spark, DIRECTORY)
    sql = oracle_sql()[name]
    types = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {sql}").fetchall()}
    assert {c: DUCK_TYPES[t] for c, t in df.dtypes} == types
    found = table(df.columns, df.collect())
    result = duck.execute(sql)
    expected = table([d[0] for d in result.description], result.fetchall())
    assert found[0] == expected[0]
    assert len(found[1]) == len(expected[1])
    assert found[1] == expected[1]


def test_every_query_returns_rows(spark):
    assert entry(spark).limit(1).count() == 1
    assert set(REGISTRY) <= set(oracle_sql()) and set(REGISTRY) <= set(queries())
