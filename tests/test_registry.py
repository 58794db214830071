"""The registered queries against their SQL twins on the smallest given tables."""

import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tools"))
from check_oracle import TABLES, rows  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="given tables not present")
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_twin_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    own = {name for name in QUERIES if name.startswith("q")}  # others are tested with their operators
    assert own <= set(ORACLE)


@pytest.mark.parametrize("name", [name for name in QUERIES if name.startswith("q") or name in ORACLE])
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    mine = rows(df.collect(), df.columns)
    if name not in ORACLE:
        assert mine
        return
    result = duck.execute(ORACLE[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    assert mine == rows(result.fetchall(), names)


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "decision_reason" in df.columns
