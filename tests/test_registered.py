"""Every registered query against its check SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

SF = "/root/testdata/sf0.001"
# The corpus operators have tests of their own.
QUERIES = {k: v for k, v in entry.queries().items() if k != "pipeline" and not k.startswith("op")}
SQL = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    if name in SQL:
        assert compare(df, duck, SQL[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
