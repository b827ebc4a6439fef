"""Registered corpus queries against their SQL in DuckDB, by schema and values."""

import os

import duckdb
import pytest

from scanledger.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TYPES = {
    "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "int": "INTEGER",
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    result = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLES[name])
    names = [c[0] for c in expected.description]
    assert sorted(names) == sorted(result.columns)
    types = dict(result.dtypes)
    assert [TYPES[types[n]] for n in names] == [str(c[1]) for c in expected.description]
    found = sorted(map(repr, map(tuple, result.select(*names).collect())))
    assert found == sorted(map(repr, expected.fetchall()))
    assert found
