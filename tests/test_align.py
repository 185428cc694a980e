from datetime import datetime

import pytest

from conftest import rows
from stationflow.config import SplitConfig
from stationflow.operators.align import (
    align_measures,
    by_time,
    ingest_report,
    ingest_wide,
    kelvin_to_celsius,
    unpivot_measure,
)
from stationflow.sources.readers import read_wide_csv

T0, T1, T2 = (datetime(2024, 1, 1, h) for h in range(3))


@pytest.fixture
def tables(spark, tmp_path):
    """Wide CSV files: a station missing from one file, leading nulls, bad numbers, a missing file."""
    texts = {
        "temperature": "datetime,A,B\n2024-01-01 00:00:00,,280.15\n2024-01-01 01:00:00,300.15,hot\n2024-01-01 02:00:00,,\n",
        "humidity": "datetime,A\n2024-01-01 00:00:00,50\n",
        "weather_desc": "datetime,A,B\n2024-01-01 01:00:00,mist,\n",
    }
    paths = {m: str(tmp_path / f"{m}.csv") for m in (*texts, "pressure")}
    for m, text in texts.items():
        (tmp_path / f"{m}.csv").write_text(text)
    return read_wide_csv(spark, paths)


def test_missing_file_gives_no_table(tables):
    assert set(tables) == {"temperature", "humidity", "weather_desc"}


def test_unpivot_keeps_nulls(tables):
    long = rows(unpivot_measure(tables["temperature"], "temperature"), "City", "datetime")
    assert long == [
        (T0, "A", None), (T1, "A", 300.15), (T2, "A", None),
        (T0, "B", 280.15), (T1, "B", None), (T2, "B", None),
    ]


def test_full_outer_alignment(tables):
    out = rows(align_measures(tables).select("datetime", "City", "temperature", "humidity", "weather_desc"), "City", "datetime")
    assert out == [
        (T0, "A", None, 50.0, None), (T1, "A", 300.15, None, "mist"), (T2, "A", None, None, None),
        (T0, "B", 280.15, None, None), (T1, "B", None, None, None), (T2, "B", None, None, None),
    ]


@pytest.mark.parametrize("split", [SplitConfig(), SplitConfig(rows_per_segment=2)])
def test_fill_stays_within_a_station(tables, split):
    out = rows(by_time(ingest_wide(tables, split=split)).select("datetime", "City", "temperature", "humidity", "weather_desc"))
    assert out == [
        (T0, "A", 27.0, 50.0, "mist"), (T0, "B", 7.0, None, None),
        (T1, "A", 27.0, 50.0, "mist"), (T1, "B", 7.0, None, None),
        (T2, "A", 27.0, 50.0, "mist"), (T2, "B", 7.0, None, None),
    ]


def test_alignment_takes_one_shuffle(tables):
    plan = align_measures(tables)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_kelvin_text_and_absent_column(spark):
    df = spark.createDataFrame([("273.15",), ("x",), (None,)], "temperature string")
    assert [r[0] for r in kelvin_to_celsius(df).collect()] == [0.0, None, None]
    other = spark.createDataFrame([(1.0,)], "humidity double")
    assert kelvin_to_celsius(other).columns == ["humidity"]


def test_report(tables):
    assert ingest_report(align_measures(tables)).first().asDict() == {"n_rows": 6, "n_cities": 2}
