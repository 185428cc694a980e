"""Queries with SQL equal it on the smallest tables."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

from check import canonical, duckdb_on  # noqa: E402

from stationflow.llm.queries import QUERIES, SQL  # noqa: E402


@pytest.mark.parametrize("name", SQL)
def test_query(spark, sf_dir, name):
    got, want = QUERIES[name](spark, sf_dir).toPandas(), duckdb_on(sf_dir).execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got).equals(canonical(want))
