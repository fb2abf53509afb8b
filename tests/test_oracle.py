"""Every registered query against its SQL on the smallest tables."""

import oracle
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    result = entry.queries()[name](spark, SF)
    if name in SQL:
        assert oracle.compare(result, con, SQL[name]) is None
    else:
        assert result.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 5


def test_sql_names_are_queries():
    assert set(SQL) <= set(entry.queries())
