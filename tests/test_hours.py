"""Features by hours against every pair of readings."""

import math
import statistics
from datetime import datetime, timedelta

import pytest

from stationflow.config import FeatureConfig, SplitConfig
from stationflow.operators import hours

START = datetime(2024, 1, 1)
CONFIG = FeatureConfig(measures=("temperature", "wind_speed"), lags=(1, 5), windows=(3, 6))


def table(spark, made):
    return spark.createDataFrame(made, "datetime timestamp, city string, temperature double, wind_speed double")


@pytest.fixture
def gappy(spark):
    """Two stations with gaps, a repeated hour, a null measure and a row without time."""
    made = [(START + timedelta(hours=h), c, float(h * h % 17), float(h % 5)) for c, step in (("A", 1), ("B", 2)) for h in range(0, 60, step) if h % 11 and h % 7]
    made += [(START + timedelta(hours=8, minutes=30), "A", 1.5, 2.5), (START + timedelta(hours=9), "A", 99.0, None), (None, "A", 3.0, 4.0), (START, None, 5.0, 6.0)]
    return made, table(spark, made)


def near(a, b):
    return a == b or (a is not None and b is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9))


@pytest.mark.parametrize("length", [7, 24 * 366])
def test_lags_and_frames_go_by_time(gappy, length):
    made, df = gappy
    split = SplitConfig(hours_per_segment=length)
    got = hours.with_hour_rolling(hours.with_hour_lags(df, CONFIG, split), CONFIG, split).collect()
    assert len(got) == len(made)
    for row in got:
        own = [r for r in made if r[1] == row["city"] and r[0] is not None]

        def back(index, least, most):
            if row["datetime"] is None:
                return [r[index] for r in made if r[0] is None and r[1] == row["city"] and least == 0]
            return [r[index] for r in own if timedelta(hours=least) <= row["datetime"] - r[0] <= timedelta(hours=most) and r[index] is not None]

        for m, index in (("temperature", 2), ("wind_speed", 3)):
            for n in CONFIG.lags:
                if row["datetime"] is not None:
                    assert row[f"{m}_hour_lag_{n}"] == max(back(index, n, n), default=None)
            for size in CONFIG.windows:
                values = back(index, 0, size)
                assert row[f"{m}_hour_count_{size}"] == len(values)
                assert near(row[f"{m}_hour_mean_{size}"], statistics.fmean(values) if values else None)
                assert near(row[f"{m}_hour_std_{size}"], statistics.stdev(values) if len(values) > 1 else None)
        assert row["wind_speed_hour_max_3"] == max(back(3, 0, 3), default=None)


def test_lookback_longer_than_a_segment(gappy):
    made, df = gappy
    config = FeatureConfig(measures=("temperature",), lags=(30,), windows=(30,))
    short, long = (hours.with_hour_lags(df, config, SplitConfig(hours_per_segment=n)) for n in (4, 10_000))
    assert sorted(map(str, short.collect())) == sorted(map(str, long.collect()))


def test_one_shuffle_and_no_python(gappy):
    plan = hours.with_hour_lags(gappy[1], CONFIG)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan


def test_empty_table(spark):
    assert hours.with_hour_lags(table(spark, []), CONFIG).count() == 0
