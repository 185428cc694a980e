import pytest
from pyspark.sql import functions as F

from conftest import rows
from stationflow.config import MEASURES, TARGETS, ModelConfig
from stationflow.operators.clean import clean_observations
from stationflow.operators.normalize import normalize_observations
from stationflow.plans import models
from stationflow.plans.batch import BatchConfig, run_batch, run_on, split_rows
from stationflow.sources import sinks
from stationflow.sources.readers import read_predictions
from stationflow.sources.synthetic import synthetic_observations

SMALL = ModelConfig(gbt_iterations=2, gbt_depth=2, forest_trees=3, forest_depth=3)
CITIES = ("Hanoi", "HoChiMinh", "DaNang")


def observations(spark, n=500):
    raw = synthetic_observations(spark, n, CITIES, ("rain", "clouds", "clear", "snow"))
    return normalize_observations(clean_observations(raw))


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("batch")
    sinks.write_lake(observations(spark), str(base / "lake"))
    config = BatchConfig(str(base / "lake"), str(base / "predictions"), str(base / "models"), model=SMALL)
    return config, run_batch(spark, config)


def test_every_target_is_trained_and_evaluated(run):
    _, result = run
    assert result.stopped is None and result.trained.failures == {}
    table = {r["target"]: r for r in result.metrics.collect()}
    assert set(table) == set(TARGETS)
    assert all(table[m]["rmse"] > 0 and table[m]["accuracy"] is None for m in MEASURES)
    assert 0 <= table["weather_desc"]["accuracy"] <= 1


def test_forecast_is_seven_midnights_per_city(run):
    _, result = run
    out = result.future
    assert out.count() == 21 and out.filter("date_trunc('day', datetime) <> datetime").isEmpty()
    assert set(out.columns) == {"datetime", "city", *[f"prediction_{t}" for t in TARGETS]}
    per_city = out.groupBy("city").agg(F.count_distinct("prediction_temperature").alias("n"), F.count("*").alias("days"))
    assert rows(per_city, "city") == [("Danang", 1, 7), ("Hanoi", 1, 7), ("Hochiminh", 1, 7)]
    last = result.scored.agg(F.max("datetime")).first()[0]
    assert out.agg(F.min("datetime")).first()[0] > last.replace(hour=0, minute=0)


def test_export_reaches_the_prediction_table(spark, run):
    config, result = run
    stored = read_predictions(spark, config.predictions)
    assert stored.count() == result.export.count() == result.scored.count() + 21
    assert stored.filter("temperature IS NULL AND prediction_temperature IS NOT NULL").count() == 21


def test_saved_models_score_alike(spark, run):
    config, result = run
    loaded = sinks.load_models(config.models, list(result.trained.models))
    names = [f"prediction_{t}" for t in TARGETS]
    plain = result.scored.drop(*names)
    assert rows(models.score_with(plain, loaded).select("city", "datetime", *names), "city", "datetime") == rows(
        result.scored.select("city", "datetime", *names), "city", "datetime"
    )


def test_scoring_keeps_rows_without_or_with_new_labels(run):
    _, result = run
    names = [f"prediction_{t}" for t in TARGETS]
    plain = result.scored.drop(*names).limit(20)
    for label in (F.lit(None).cast("string"), F.lit("never seen")):
        assert models.score(plain.withColumn("weather_desc", label), result.trained).count() == 20
    assert models.score(plain.drop(*TARGETS), result.trained).count() == 20


def test_learners_follow_the_table():
    assert type(models.regressor("temperature")).__name__ == "GBTRegressor"
    assert type(models.regressor("wind_speed")).__name__ == "RandomForestRegressor"
    assert type(models.regressor("anything")).__name__ == "GBTRegressor"
    assert models.regressor("humidity").getMaxIter() == 50 and models.regressor("wind_speed").getNumTrees() == 50


def test_failing_and_empty_targets_are_reported(spark):
    df = spark.range(60).select(
        F.rand(1).alias("x"), F.rand(2).alias("temperature"), F.lit(None).cast("double").alias("humidity"),
        F.lit("text").alias("pressure"),
    )
    trained = models.train_models(df, ["x"], SMALL)
    assert set(trained.models) == {"temperature"}
    assert trained.failures["humidity"] == "no labelled rows" and "pressure" in trained.failures


def test_job_stops_early(spark, tmp_path):
    empty = run_batch(spark, BatchConfig(str(tmp_path / "none")))
    assert empty.stopped and empty.trained is None
    few = run_on(observations(spark, 60), BatchConfig("", model=SMALL))
    assert few.stopped == "fewer than 50 training rows"
    poor = run_on(observations(spark, 20).drop("pressure"), BatchConfig(""))
    assert "quality score" in poor.stopped
    with pytest.raises(ValueError):
        split_rows(observations(spark, 20), "thirds", SMALL)
