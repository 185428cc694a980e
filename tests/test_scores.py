import math

import pytest
from pyspark.sql import functions as F

from stationflow.functions import scores
from stationflow.functions.calendar import calendar_columns, daytime_flag, season
from stationflow.operators.enrich import with_comfort, with_risk


def evaluate(spark, column, **values):
    frame = spark.createDataFrame(
        [tuple(values.values())], ", ".join(f"{n} {'string' if isinstance(v, str) else 'double'}" for n, v in values.items())
    )
    return frame.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "wind,points",
    [(-3, 0), (0, 0), (20, 0), (20.5, 10.25), (50, 25), (50.1, 30), (100, 30), (100.1, 40), (None, 0)],
)
def test_wind(spark, wind, points):
    assert evaluate(spark, scores.wind_score(F.col("w")), w=None if wind is None else float(wind)) == points


@pytest.mark.parametrize(
    "t,points", [(-10.1, 30), (-10, 15), (-0.1, 15), (0, 0), (35, 0), (35.1, 15), (45, 15), (45.1, 30), (None, 0)]
)
def test_temperature(spark, t, points):
    assert evaluate(spark, scores.temperature_score(F.col("t")), t=None if t is None else float(t)) == points


@pytest.mark.parametrize("p,points", [(979.9, 30), (980, 15), (999.9, 15), (1000, 0), (None, 0)])
def test_pressure(spark, p, points):
    assert evaluate(spark, scores.pressure_score(F.col("p")), p=None if p is None else float(p)) == points


@pytest.mark.parametrize(
    "text,points",
    [("Tornado rain", 50), ("HURRICANE", 50), ("thunderstorm", 30), ("snowstorm", 30), ("light rain", 15), ("snow", 15), ("clear", 0)],
)
def test_keywords(spark, text, points):
    assert evaluate(spark, scores.keyword_score(F.col("d")), d=text) == points


@pytest.mark.parametrize("score,level", [(70, "CRITICAL"), (69.9, "HIGH"), (40, "HIGH"), (39.9, "MEDIUM"), (20, "MEDIUM"), (19.9, "LOW")])
def test_levels(spark, score, level):
    assert evaluate(spark, scores.emergency_level(F.col("s")), s=float(score)) == level


def test_score_is_capped_and_null_safe(spark):
    df = spark.createDataFrame(
        [(50.0, 950.0, 120.0, "tornado"), (None, None, None, None)],
        "temperature double, pressure double, wind_speed double, weather_desc string",
    )
    out = [(r["disaster_risk_score"], r["emergency_level"]) for r in with_risk(df).collect()]
    assert out == [(100.0, "CRITICAL"), (0.0, "LOW")]


def test_comfort(spark):
    df = spark.createDataFrame(
        [("2024-01-01 06:00:00", 30.0, 50.0, 10.0), ("2024-01-01 19:00:00", 5.0, 50.0, 10.0), ("2024-01-01 18:59:00", 5.0, 50.0, 5.0)],
        "datetime string, temperature double, humidity double, wind_speed double",
    ).withColumn("datetime", F.col("datetime").cast("timestamp"))
    warm, cold, calm = with_comfort(df).collect()
    assert warm["heat_index_c"] == pytest.approx(30 + 0.55 * 0.5 * 15.5) and warm["wind_chill_c"] == 30
    v = 10**0.16
    assert cold["wind_chill_c"] == pytest.approx(13.12 + 0.6215 * 5 - 11.37 * v + 0.3965 * 5 * v)
    assert calm["wind_chill_c"] == 5.0
    assert [r["is_daytime"] for r in (warm, cold, calm)] == [1, 0, 1]


def test_feature_variants(spark):
    assert evaluate(spark, scores.heat_index(F.col("t"), F.col("h")), t=30.0, h=50.0) == pytest.approx(55.0)
    assert evaluate(spark, scores.wind_chill(F.col("t"), F.col("w")), t=9.0, w=6.0) == pytest.approx(6.6)
    assert evaluate(spark, scores.wind_chill(F.col("t"), F.col("w")), t=10.0, w=6.0) == 10.0
    for now, then, trend in [(3.0, 0.5, "rising"), (2.0, 0.0, "stable"), (0.0, 2.1, "falling"), (1.0, None, "stable")]:
        assert evaluate(spark, scores.pressure_tendency(F.col("a"), F.col("b")), a=now, b=then) == trend


def test_calendar(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-07 18:30:00' AS t")  # a Sunday
    row = df.select(*[c.alias(n) for n, c in calendar_columns(F.col("t")).items()]).first()
    assert (row["hour_of_day"], row["day_of_week"], row["month_of_year"], row["season"]) == (18, 1, 1, "winter")
    assert row["hour_sin"] == pytest.approx(-1) and row["month_cos"] == pytest.approx(math.cos(0))
    months = spark.range(1, 13).select(season(F.col("id")).alias("s")).collect()
    assert [m["s"] for m in months] == ["winter"] * 2 + ["spring"] * 3 + ["summer"] * 3 + ["fall"] * 3 + ["winter"]
    hours = spark.range(24).select(daytime_flag(F.col("id")).alias("d")).collect()
    assert [h["d"] for h in hours] == [0] * 6 + [1] * 13 + [0] * 5
