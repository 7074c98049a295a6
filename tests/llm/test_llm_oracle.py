import pytest
from helpers import SF_DIR, assert_same, connection

from millrace.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def con():
    return connection()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, con, name):
    assert_same(QUERIES[name](spark, SF_DIR), SQL[name], con)
