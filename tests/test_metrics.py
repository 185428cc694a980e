import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from conftest import rows
from stationflow.operators import metrics

PAIRS = "temperature double, prediction_temperature double, weather_desc string, prediction_weather_desc string"


@pytest.fixture
def scored(spark):
    made = [
        (10.0, 12.0, "rain", "rain"), (20.0, 19.0, "rain", "clear"), (0.0, 0.5, "clear", "clear"), (-5.0, -9.0, "snow", "rain"),
        (None, 1.0, None, "rain"), (1.0, None, "fog", None), (7.0, 7.0, "clear", "hail"),
    ]
    return spark.createDataFrame(made, PAIRS)


def test_regression_equals_mllib(scored):
    row = metrics.regression_metrics(scored).first()
    pairs = scored.select("temperature", "prediction_temperature").dropna()
    for name in ("rmse", "mae", "r2"):
        evaluator = RegressionEvaluator(labelCol="temperature", predictionCol="prediction_temperature", metricName=name)
        assert row[name] == pytest.approx(evaluator.evaluate(pairs))
    want = [(2 / 10.001), (1 / 20.001), (0.5 / 0.001), (4 / 5.001), 0]
    assert row["mape"] == pytest.approx(sum(want) / 5 * 100)
    assert (row["target"], row["sample_count"]) == ("temperature", 5)


def test_classification_equals_mllib(scored):
    row = metrics.classification_metrics(scored).first()
    pairs = scored.select("weather_desc", "prediction_weather_desc").dropna()
    both = pairs.select(F.explode(F.array("weather_desc", "prediction_weather_desc")).alias("c"))
    indexer = StringIndexer(inputCol="c", outputCol="i").fit(both)
    indexed = indexer.transform(pairs.withColumnRenamed("weather_desc", "c")).withColumnRenamed("i", "label").drop("c")
    indexed = indexer.transform(indexed.withColumnRenamed("prediction_weather_desc", "c")).withColumnRenamed("i", "prediction")
    names = {"accuracy": "accuracy", "f1": "f1", "precision": "weightedPrecision", "recall": "weightedRecall"}
    for name, theirs in names.items():
        assert row[name] == pytest.approx(MulticlassClassificationEvaluator(metricName=theirs).evaluate(indexed))
    assert row["sample_count"] == 5


def test_all_metrics_skip_absent_targets(scored):
    table = metrics.all_metrics(scored)
    assert rows(table.select("target"), "target") == [("temperature",), ("weather_desc",)]
    assert table.filter("target = 'weather_desc'").first()["rmse"] is None
    assert metrics.all_metrics(scored.drop("temperature", "weather_desc")).count() == 0
    nothing = scored.withColumn("prediction_temperature", F.lit(None).cast("double"))
    assert metrics.regression_metrics(nothing).count() == 0


def test_constant_target_has_no_r2(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "temperature double, prediction_temperature double")
    assert metrics.regression_metrics(df).first()["r2"] is None


def test_bands(spark):
    df = spark.createDataFrame([("a", 0.8), ("b", 0.79), ("c", 0.5), ("d", 0.49), ("e", None)], "target string, r2 double")
    out = [r["band"] for r in metrics.accuracy_bands(df).orderBy("target").collect()]
    assert out == ["good", "fair", "fair", "poor"]
