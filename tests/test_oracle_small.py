"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as entry
from oracle_compare import compare, duck_connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    r = compare(df, con, entry.oracle_sql()[name])
    assert r["values_match"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "dept_name" in df.columns
