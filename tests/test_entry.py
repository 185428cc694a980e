"""Every registered query equals its SQL on the smallest tables."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

import __spark_entry__ as entry_point  # noqa: E402
from check import canonical, duckdb_on  # noqa: E402

QUERIES, SQL = entry_point.queries(), entry_point.oracle_sql()
OWN = set(entry_point.LLM.QUERIES) | {"pipeline"} if entry_point.LLM else set()


@pytest.fixture(scope="module")
def tables():
    return duckdb_on("/root/testdata/sf0.001")


def test_no_query_lacks_sql():
    assert set(QUERIES) - set(SQL) <= OWN and not set(SQL) - set(QUERIES)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL and n not in OWN])
def test_query(spark, sf_dir, tables, name):
    got, want = QUERIES[name](spark, sf_dir).toPandas(), tables.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got).equals(canonical(want))


def test_flagship(spark):
    result = entry_point.entry(spark)
    assert result.count() > 0 and "emergency_level" in result.columns
