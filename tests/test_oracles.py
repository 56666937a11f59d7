"""Every registered query against its DuckDB oracle at sf0.01; without an oracle, rows must come."""

import pytest

import __spark_entry__ as entry
from oracle import compare, duck

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, con, sql) == []


def test_entry(spark):
    assert entry.entry(spark).count() == 4
