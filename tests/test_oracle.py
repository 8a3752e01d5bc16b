"""Every registered query against its SQL on the smallest test data."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from check import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, con, name):
    ok, note = compare(spark, con, name, SF)
    assert ok, note


def test_entry(spark):
    assert entry(spark).count() > 0
