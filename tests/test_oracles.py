"""Every query with a SQL check gives the same rows as DuckDB."""

import pytest
from compare import difference, oracle

import __spark_entry__ as entry

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, con, name):
    assert difference(QUERIES[name](spark, sf_dir), con, SQL[name]) is None


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
