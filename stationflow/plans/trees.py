"""Fitted regression trees as tables of nodes, and scores from such tables.

A tree model is saved as a table, one row per node, that any tool can read. Here
it becomes ``tree, weight, node, feature, threshold, left, right, prediction, rows,
gain, depth``, and a row is scored by walking that table: no vector, no model object.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import with_label
from ..session import shared_dir
from .models import VECTOR

TreeModel = DecisionTreeRegressionModel | GBTRegressionModel | RandomForestRegressionModel
LEAF = -1
#: Nodes of a model that are made into one array; 50 trees of depth 8 have at most 25,550.
MOST_NODES = 100_000


def fit_stump(df: DataFrame, inputs: Sequence[str], target: str, depth: int = 1, bins: int = 64) -> DecisionTreeRegressionModel:
    """One tree on the rows that have the target and all inputs.

    Inputs of at most ``bins`` distinct values are tried at every split.
    """
    rows = with_label(df.select(*inputs, target), target)
    vectors = VectorAssembler(inputCols=list(inputs), outputCol=VECTOR, handleInvalid="skip").transform(rows)
    return DecisionTreeRegressor(featuresCol=VECTOR, labelCol=target, maxDepth=depth, maxBins=bins, seed=0).fit(vectors)


def nodes_of(model: TreeModel, inputs: Sequence[str]) -> DataFrame:
    """The nodes of a regression tree or ensemble, ``feature`` by name and null in leaves.

    ``weight`` is the tree's share in the score: of a forest, one by the number of trees. ``depth`` is that of the deepest tree.
    """
    spark = SparkSession.active()
    path = shared_dir(spark, "trees")
    model.write().save(path)
    saved = spark.read.parquet(f"{path}/data")
    if isinstance(model, DecisionTreeRegressionModel):
        nodes = saved.select(F.lit(0).alias("tree"), F.struct("*").alias("n"))
        weights, depth = {0: 1.0}, model.depth
    else:
        nodes = saved.select(F.col("treeID").alias("tree"), F.col("nodeData").alias("n"))
        each = 1 / model.getNumTrees if isinstance(model, RandomForestRegressionModel) else 1.0
        weights, depth = {i: w * each for i, w in enumerate(model.treeWeights)}, max(t.depth for t in model.trees)
    name, share = F.lit(None).cast("string"), F.lit(None).cast("double")
    for i, column in enumerate(inputs):
        name = F.when(F.col("n.split.featureIndex") == i, column).otherwise(name)
    for i, weight in weights.items():
        share = F.when(F.col("tree") == i, weight).otherwise(share)
    return nodes.select(
        "tree",
        share.alias("weight"),
        F.col("n.id").alias("node"),
        name.alias("feature"),
        F.get("n.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.col("n.leftChild").alias("left"),
        F.col("n.rightChild").alias("right"),
        F.col("n.prediction").alias("prediction"),
        F.col("n.rawCount").alias("rows"),
        F.when(name.isNotNull(), F.col("n.gain")).alias("gain"),
        F.lit(depth).alias("depth"),
    )


def _walk(nodes: Column, values: Column, depth: int) -> Column:
    """Prediction of the leaf that ``values`` lead to, from node 0 down."""

    def step(at: Column, _: Column) -> Column:
        here = F.get(nodes, at)
        down = F.when(F.get(values, here["feature"]) <= here["threshold"], here["left"]).otherwise(here["right"])
        return F.when(here["feature"] == LEAF, at).otherwise(down)

    return F.get(nodes, F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step))["prediction"]


def score_by_nodes(df: DataFrame, inputs: Sequence[str], nodes: DataFrame, column: str = "prediction") -> DataFrame:
    """Add ``column``, the weighted sum of the trees' predictions, from their table.

    The table is one array that travels with the tasks; more than ``MOST_NODES`` nodes are refused. A null
    input counts as greater than any threshold.
    """
    size, depth = nodes.agg(F.count("*"), F.max("depth")).first()
    if size > MOST_NODES:
        raise ValueError(f"more than {MOST_NODES} nodes")
    number = F.lit(LEAF)
    for i, name in enumerate(inputs):
        number = F.when(F.col("feature") == name, i).otherwise(number)
    node = F.struct("node", number.alias("feature"), F.coalesce("threshold", F.lit(0.0)).alias("threshold"), "left", "right", "prediction")
    trees = nodes.groupBy("tree", "weight").agg(F.array_sort(F.collect_list(node)).alias("nodes"))
    all_trees = trees.agg(F.collect_list(F.struct("weight", "nodes")).alias("_trees"))
    values = F.array(*[F.col(c).cast("double") for c in inputs])
    total = F.aggregate("_trees", F.lit(0.0), lambda s, t: s + t["weight"] * _walk(t["nodes"], F.col("_values"), max(depth or 0, 1)))
    return (
        df.withColumn("_values", values)
        .join(F.broadcast(all_trees))  # one row
        .withColumn(column, total)
        .select(*df.columns, column)
    )
