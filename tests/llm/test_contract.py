"""The registered queries, and those that SQL can express against DuckDB."""

import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from playmart.llm.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.01"


def test_one_query_for_each_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES) and QUERIES.items() <= contract.queries().items()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    result = connection.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    expected = Counter(result.fetchall())
    df = QUERIES[name](spark, SF_DIR)
    assert sorted(df.columns) == sorted(columns)
    assert Counter(tuple(r) for r in df.select(*columns).collect()) == expected
