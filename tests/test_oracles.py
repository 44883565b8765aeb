"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry
from conftest import SMALL
from tools.oracle_check import compare, duck

NAMES = sorted(entry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), SMALL)
    assert res["status"] == "ok" or res["status"] == "no-oracle" and res["rows"] > 0, res
