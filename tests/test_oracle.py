import pytest
from helpers import SF_DIR, assert_same, connection

from millrace.plans import registry

SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connection()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, con, name):
    assert_same(registry.queries()[name](spark, SF_DIR), SQL[name], con)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(registry.queries())
