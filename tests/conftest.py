import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from stationflow.session import build_session

    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    return TESTDATA


def rows(df, *order):
    """Collected rows as tuples, ordered by columns."""
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
