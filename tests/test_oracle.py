"""Every query with an SQL twin gives the same rows on the smallest warehouse."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, duck

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, con, name):
    assert compare(spark, con, SF_DIR, QUERIES[name], ORACLES[name]) is None


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.count() == 5
    assert "recommendations" in frame.columns
