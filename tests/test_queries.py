"""Every registered query against DuckDB on the smallest test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_file

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TYPES = {"smallint": "SMALLINT", "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "float": "FLOAT",
         "double": "DOUBLE", "boolean": "BOOLEAN"}
#: The queries of the subpackage for training data have tests of their own.
CORPUS = {"pipeline", *(entry_file.llm.QUERIES if entry_file.llm else ())}
QUERIES = {name: query for name, query in entry_file.queries().items() if name not in CORPUS}
ORACLES = {name: sql for name, sql in entry_file.oracle_sql().items() if name not in CORPUS}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute(f"create view events as select * from '{SF_DIR}/events.parquet'")
    return connection


def test_all_have_a_check():
    assert QUERIES.keys() == ORACLES.keys()


def test_entry(spark):
    assert entry_file.entry(spark).count() == 1000


def in_order(rows):
    return sorted(rows, key=lambda r: [(x is None, str(x)) for x in r])


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = in_order(tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    cursor = duck.execute(ORACLES[name])
    types = {c[0]: str(c[1]) for c in cursor.description}
    places = [list(types).index(c) for c in columns]
    want = in_order(tuple(r[i] for i in places) for r in cursor.fetchall())
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    assert got == want
