"""Training and scoring one model per target with MLlib.

All targets use the same inputs, so the vector is assembled and scaled once and
every learner trains on that one column.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame

from ..config import TARGETS, ModelConfig
from ..operators.clean import with_label

log = logging.getLogger(__name__)

VECTOR = "features"
RAW_VECTOR = "features_raw"


@dataclass
class Trained:
    """Fitted scoring pipelines by target, and why a target has none."""

    vectorizer: PipelineModel
    models: dict[str, PipelineModel] = field(default_factory=dict)
    failures: dict[str, str] = field(default_factory=dict)


def vector_pipeline(inputs: Sequence[str]) -> Pipeline:
    """Assemble and standardise; rows with a missing input are skipped."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(inputs), outputCol=RAW_VECTOR, handleInvalid="skip"),
            StandardScaler(inputCol=RAW_VECTOR, outputCol=VECTOR, withMean=True, withStd=True),
        ]
    )


def regressor(target: str, config: ModelConfig = ModelConfig()):
    """Boosted trees by default, a forest where the config says so."""
    columns = {"featuresCol": VECTOR, "labelCol": target, "predictionCol": f"prediction_{target}"}
    if config.learners.get(target, "gbt") == "forest":
        return RandomForestRegressor(
            numTrees=config.forest_trees, maxDepth=config.forest_depth, seed=config.seed, **columns
        )
    return GBTRegressor(
        maxIter=config.gbt_iterations, maxDepth=config.gbt_depth, stepSize=config.gbt_step,
        seed=config.seed, **columns,
    )


def classifier_stages(target: str, config: ModelConfig = ModelConfig()) -> tuple[StringIndexer, RandomForestClassifier]:
    """Label indexer and forest; output columns carry the target so chains do not collide."""
    indexer = StringIndexer(inputCol=target, outputCol=f"label_{target}", handleInvalid="skip")
    forest = RandomForestClassifier(
        featuresCol=VECTOR,
        labelCol=f"label_{target}",
        predictionCol=f"index_{target}",
        rawPredictionCol=f"raw_{target}",
        probabilityCol=f"probability_{target}",
        numTrees=config.forest_trees,
        maxDepth=config.forest_depth,
        seed=config.seed,
    )
    return indexer, forest


def fit_regressor(train: DataFrame, target: str, config: ModelConfig = ModelConfig()) -> PipelineModel:
    return PipelineModel([regressor(target, config).fit(with_label(train, target))])


def fit_classifier(train: DataFrame, target: str, config: ModelConfig = ModelConfig()) -> PipelineModel:
    """The fitted forest and the decoding of its index.

    The label indexer is only used for training: kept in the scoring pipeline it
    would drop rows whose actual label is null or new.
    """
    indexer, forest = classifier_stages(target, config)
    if with_label(train, target).select(target).distinct().limit(config.most_labels + 1).count() > config.most_labels:
        raise ValueError(f"{target} has more than {config.most_labels} labels")
    labels = indexer.fit(with_label(train, target))
    model = forest.fit(labels.transform(train))
    decode = IndexToString(inputCol=f"index_{target}", outputCol=f"prediction_{target}", labels=labels.labels)
    return PipelineModel([model, decode])


def train_models(
    train: DataFrame,
    inputs: Sequence[str],
    config: ModelConfig = ModelConfig(),
    targets: Sequence[str] = TARGETS,
    persist: bool = True,
) -> Trained:
    """Fit every target; one that fails or has no labels does not stop the others."""
    vectorizer = vector_pipeline(inputs).fit(train)
    present = [t for t in targets if t in train.columns]
    vectors = vectorizer.transform(train).select(VECTOR, *present)
    if persist:
        vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    trained = Trained(vectorizer)

    def train_one(target: str) -> PipelineModel | str:
        if with_label(vectors, target).isEmpty():
            return "no labelled rows"
        fit = fit_classifier if config.learners.get(target) == "forest_classifier" else fit_regressor
        try:
            return fit(vectors, target, config)
        except Exception as error:
            log.exception("training %s failed", target)
            return str(error)

    try:
        with ThreadPoolExecutor(config.parallelism) as pool:
            task = inheritable_thread_target(train.sparkSession)(train_one)
            results = list(pool.map(task, present))
    finally:
        if persist:
            vectors.unpersist()
    for target, result in zip(present, results, strict=True):
        (trained.failures if isinstance(result, str) else trained.models)[target] = result
    return trained


def score(df: DataFrame, trained: Trained) -> DataFrame:
    """Add ``prediction_*`` of every model; helper columns are dropped."""
    scored = trained.vectorizer.transform(df)
    for model in trained.models.values():
        scored = model.transform(scored)
    predictions = [f"prediction_{t}" for t in trained.models]
    return scored.select(*df.columns, *predictions)


def scoring_pipelines(trained: Trained) -> dict[str, PipelineModel]:
    """Self-contained pipelines per target, for saving."""
    return {t: PipelineModel([*trained.vectorizer.stages, *m.stages]) for t, m in trained.models.items()}


def score_with(df: DataFrame, pipelines: Mapping[str, PipelineModel]) -> DataFrame:
    """Score with loaded pipelines, each of which builds its own vector."""
    for target, model in pipelines.items():
        scored = model.transform(df)
        df = scored.select(*df.columns, f"prediction_{target}")
    return df


