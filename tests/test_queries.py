"""Every registered query against its SQL on the smallest given tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", [n for n in entry.queries() if n in entry.oracle_sql()])
def test_query(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    assert compare(con, df, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
