"""Every registered query with SQL equals DuckDB on the whole small tables."""

import pytest

import __spark_entry__ as entry_module
from check_oracle import compare, connect
from kinomill import catalog

QUERIES = {key: entry_module.queries()[key] for key in catalog.queries()}
SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


def test_sql_has_no_orphans():
    assert not SQL.keys() - QUERIES.keys()
    assert sorted(QUERIES.keys() - SQL.keys()) == []


def test_entry_runs(spark):
    assert entry_module.entry(spark).columns == ["decade", "genre", "n"]


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, small, duck, key):
    message = compare(QUERIES[key](spark, small), duck, SQL.get(key))
    assert message is None or message.startswith("rows only"), message
