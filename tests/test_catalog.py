"""Every named query against its SQL, over whole tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import compare, connect

FOLDER = os.environ.get("MARTKIT_TEST_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    df = queries()[name](spark, FOLDER)
    sql = oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        difference = compare(df, con, sql)
        assert difference is None, difference


def test_entry(spark):
    assert entry(spark).columns == ["day", "n", "moving_avg"]
