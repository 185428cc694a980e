import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from stationflow.operators import outliers, quality
from stationflow.schema import OBSERVATION
from stationflow.sources.synthetic import synthetic_observations
from stationflow.operators.clean import clean_observations


def readings(spark, n=200):
    return clean_observations(synthetic_observations(spark, n, cities=("A", "B")))


def test_good_table(spark):
    row = quality.quality_score(readings(spark)).first()
    assert (row["quality_score"], row["band"], row["total_records"], row["time_span_days"]) == (100.0, "GOOD", 200, 8)
    assert quality.quality_gate(readings(spark)).passed


def test_empty_table_scores_zero(spark):
    gate = quality.quality_gate(spark.createDataFrame([], OBSERVATION))
    assert (gate.passed, gate.score, gate.rows) == (False, 0.0, 0)


@pytest.mark.parametrize(
    "change,score",
    [
        (lambda df: df.drop("pressure"), 80.0),
        (lambda df: df.withColumn("humidity", F.lit(None).cast("double")), 95.0),
        (lambda df: df.withColumn("humidity", F.lit(float("nan"))), 95.0),
        (lambda df: df.withColumn("weather_desc", F.lit(None).cast("string")), 95.0),
        (lambda df: df.orderBy("datetime").limit(49), 70.0),
        (lambda df: df.orderBy("datetime").limit(20), 55.0),
        (lambda df: df.orderBy("datetime").limit(20).drop("pressure"), 35.0),
    ],
)
def test_penalties(spark, change, score):
    assert quality.quality_score(change(readings(spark))).first()["quality_score"] == score


def test_bands(spark):
    df = spark.createDataFrame([(80.0,), (79.9,), (60.0,), (59.9,), (-10.0,)], "s double")
    bands = [r[0] for r in df.select(quality.quality_band(F.col("s"))).collect()]
    assert bands == ["GOOD", "ACCEPTABLE", "ACCEPTABLE", "POOR", "POOR"]


def test_report(spark):
    df = readings(spark).withColumn("humidity", F.when(F.col("city") == "A", F.lit(1.0))).drop("pressure")
    report = {r["feature"]: r for r in quality.quality_report(df).collect()}
    assert not report["pressure"]["present"] and report["pressure"]["missing_count"] is None
    absent = df.filter("city = 'B'").count()
    assert report["humidity"]["missing_count"] == absent
    assert report["humidity"]["missing_pct"] == pytest.approx(absent / 2)
    assert (report["humidity"]["min_value"], report["weather_desc"]["min_value"]) == (1.0, None)
    assert quality.absent_columns(df) == ["pressure"]


def test_summaries(spark):
    df = readings(spark)
    assert rows(quality.cities(df)) == [("A",), ("B",)]
    assert rows(quality.first_cities(df, 1)) == [("A",)]
    assert tuple(quality.data_summary(df).first()) == (200, 8, 2)
    assert quality.preview(df, 3).count() == 3 and quality.row_count(df) == 200


@pytest.mark.parametrize("kind", ["uniform", "skewed", "huge", "ties", "single"])
def test_exact_quantiles(spark, kind):
    rng = random.Random(7)
    made = {
        "uniform": [rng.uniform(-50, 60) for _ in range(999)],
        "skewed": [rng.lognormvariate(0, 9) for _ in range(500)] + [5.0] * 300,
        "huge": [-1e308, 1e308, 1e-300, -1e-300, 0.0, math.inf, -math.inf, 1.0],
        "ties": [1.0] * 10 + [2.0] * 3,
        "single": [4.25],
    }[kind]
    df = spark.createDataFrame([(v,) for v in [*made, None, math.nan]], "v double").repartition(4)
    ordered, shares = sorted(made), [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    want = [ordered[max(1, math.ceil(round(p * len(made), 9))) - 1] for p in shares]
    assert outliers.exact_quantiles(df, "v", shares) == want


def test_iqr_filter(spark):
    df = spark.createDataFrame([(float(v),) for v in [*range(1, 12), 100]] + [(None,)], "v double")
    assert outliers.without_outliers(df, "v", error=0).agg(F.max("v"), F.count("*")).first() == (11.0, 11)
    assert outliers.without_outliers(df, "v").agg(F.max("v")).first()[0] == 11.0
    empty = spark.createDataFrame([(None,), (None,)], "v double")
    assert outliers.without_outliers(empty, "v").count() == 2
    assert outliers.without_outliers(empty, "v", error=0).count() == 2
    assert outliers.without_outliers(df, "absent").count() == 13


def test_impute(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (math.nan, None), (3.0, None)], "a double, b double")
    assert rows(outliers.impute(df, ["a", "b"]), "a") == [(1.0, None), (2.0, None), (2.0, None), (3.0, None)]
    assert rows(outliers.impute(df, ["a", "b"], "zero"))[1] == (0.0, 0.0)
    with pytest.raises(ValueError):
        outliers.impute(df, ["a"], "median")
