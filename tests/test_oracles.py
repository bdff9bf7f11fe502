"""Every registered query against its DuckDB statement, as row multisets."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from playmart.oracles import ORACLES
from playmart.registry import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TYPES = {"VARCHAR": "string", "INTEGER": "int", "BIGINT": "bigint", "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean", "DECIMAL(23,5)": "decimal(23,5)", "DECIMAL(18,0)": "decimal(18,0)"}
TABLES = ["events", "customer", "nation", "part"]


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= contract.queries().items()
    assert ORACLES.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, oracle, name):
    result = oracle.execute(ORACLES[name])
    expected_columns = [d[0] for d in result.description]
    expected = Counter(result.fetchall())
    df = QUERIES[name](spark, SF_DIR)
    assert sorted(df.columns) == sorted(expected_columns)
    expected_types = {d[0]: TYPES[str(d[1])] for d in result.description}
    assert {f.name: f.dataType.simpleString() for f in df.schema} == expected_types
    rows = [tuple(r) for r in df.select(*expected_columns).collect()]
    assert Counter(rows) == expected
    assert rows


def test_entry_is_ordered_by_hour(spark):
    df = contract.entry(spark)
    hours = [r.hour for r in df.collect()]
    assert df.columns == ["hour", "song_plays"]
    assert hours == sorted(hours) and hours
