"""Scores from node tables equal those of the model."""

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from stationflow.plans import trees

INPUTS = ["a", "b"]


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(400).select(
        (F.col("id") % 24).cast("double").alias("a"), (F.col("id") % 7).cast("int").alias("b"), (F.when(F.col("id") % 24 > 9, 3).otherwise(0) + F.col("id") % 5).cast("double").alias("y")
    )


@pytest.fixture(scope="module")
def vectors(table):
    return VectorAssembler(inputCols=INPUTS, outputCol="v").transform(table)


@pytest.mark.parametrize("learner", [lambda: GBTRegressor(maxIter=4, maxDepth=3, seed=1), lambda: RandomForestRegressor(numTrees=5, maxDepth=4, seed=1)])
def test_ensembles(table, vectors, learner):
    model = learner().setFeaturesCol("v").setLabelCol("y").fit(vectors)
    nodes = trees.nodes_of(model, INPUTS)
    assert nodes.select("tree").distinct().count() == model.getNumTrees
    want = {(r["a"], r["b"]): r["prediction"] for r in model.transform(vectors).collect()}
    for r in trees.score_by_nodes(table, INPUTS, nodes, "score").collect():
        assert r["score"] == pytest.approx(want[r["a"], r["b"]], abs=1e-9)


def test_a_stump_and_rows_without_input_or_target(spark, table):
    more = table.union(spark.createDataFrame([(None, 1, 9.0), (5.0, 1, None)], table.schema))
    nodes = trees.nodes_of(trees.fit_stump(more, INPUTS, "y"), INPUTS)
    root = nodes.filter("feature IS NOT NULL").first()
    assert (root["feature"], root["threshold"], root["rows"], root["depth"]) == ("a", 9.5, 400, 1)
    scored = trees.score_by_nodes(more, INPUTS, nodes)
    assert scored.columns == ["a", "b", "y", "prediction"] and scored.count() == 402
    assert scored.filter("a = 5 AND prediction > 2.5 OR a IS NULL AND prediction < 2.5").isEmpty()


def test_a_model_without_split(spark):
    flat = spark.createDataFrame([(1.0, 1, 2.0), (2.0, 1, 2.0)], "a double, b int, y double")
    nodes = trees.nodes_of(trees.fit_stump(flat, INPUTS, "y"), INPUTS)
    assert [r["prediction"] for r in trees.score_by_nodes(flat, INPUTS, nodes).collect()] == [2.0, 2.0]


def test_too_many_nodes_are_refused(table, monkeypatch):
    nodes = trees.nodes_of(trees.fit_stump(table, INPUTS, "y"), INPUTS)
    monkeypatch.setattr(trees, "MOST_NODES", 2)
    with pytest.raises(ValueError, match="nodes"):
        trees.score_by_nodes(table, INPUTS, nodes)
