"""Every checked query against DuckDB on the small tables."""

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    """Those for training text may do without; their own tests hold them against plain versions."""
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) <= set(entry._TEXT_QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


# Nothing of these kinds exists at this size; the larger tables are checked by check_oracle.py.
MAY_BE_EMPTY = {"log_errors", "log_error_tail"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    problem = compare(QUERIES[name](spark, FOLDER), con, SQL[name])
    if name in MAY_BE_EMPTY and problem == "no rows on either side":
        problem = None
    assert problem is None, problem
