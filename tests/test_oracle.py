"""Every registered query against DuckDB on the same tables."""

from functools import lru_cache

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalog import queries as Q
from catalog.oracle import oracles
from catalog.queries import registered

QUERIES, EXPECTED = registered(), oracles()
SPARK_TO_DUCKDB = {"bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN",
                   "double": "DOUBLE"}


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW events AS SELECT * FROM '{sf}/events.parquet'")
    return connection


@pytest.fixture(scope="module", autouse=True)
def shared_steps():
    """Steps that many queries begin with run once for all of them."""
    names = ("whole", "stored_documents", "second", "kept_documents", "quarantine", "raw_files", "two_batches")
    own = {name: getattr(Q, name) for name in names}
    for name, step in own.items():
        setattr(Q, name, lru_cache(maxsize=None)(step))
    yield
    for name, step in own.items():
        setattr(Q, name, step)


def test_every_query_has_an_expectation():
    assert set(QUERIES) == set(EXPECTED)
    assert set(QUERIES) <= set(queries()) and set(EXPECTED) <= set(oracle_sql())


def compare(spark, duck, sf, name):
    df = QUERIES[name](spark, sf)
    got = sorted(str(tuple(row[c] for c in sorted(df.columns))) for row in df.collect())
    result = duck.execute(EXPECTED[name])
    types = {c[0]: str(c[1]) for c in result.description}
    names = [c[0] for c in result.description]
    order = [names.index(c) for c in sorted(names)]
    expected = sorted(str(tuple(row[i] for i in order)) for row in result.fetchall())
    assert {n: SPARK_TO_DUCKDB[t] for n, t in df.dtypes} == types
    assert got == expected


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, sf, name):
    compare(spark, duck, sf, name)


# Interpreted plans run far sooner on so few rows; these cover all operators of a batch once
# more the way they run in production.
@pytest.mark.parametrize("name", ["enrich_trace", "verdict", "trace_documents", "embed_documents"])
def test_query_in_generated_code(spark, duck, sf, name, generated_code):
    compare(spark, duck, sf, name)


def test_entry_has_a_stable_schema(spark):
    df = entry(spark)
    assert df.schema == entry(spark).schema and df.count() > 0
