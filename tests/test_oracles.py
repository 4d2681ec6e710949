import pytest
from compare import compare, connect

import __spark_entry__ as entry

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, sf, con, name):
    ok, message, _ = compare(spark, con, sf, name, entry.queries()[name], SQL[name])
    assert ok, message
