"""The batch job: lake -> quality gate -> features -> models -> forecast -> export."""

from __future__ import annotations

import argparse
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..config import FeatureConfig, ModelConfig, QualityConfig, SplitConfig
from ..operators.clean import complete_rows
from ..operators.combine import hash_split, history_plus_future, random_split, time_split
from ..operators.features import build_features, feature_names
from ..operators.metrics import all_metrics
from ..operators.quality import Gate, quality_gate
from ..session import build_session, drop_staged, stage
from ..sources.readers import load_observations
from ..sources.sinks import save_models, upsert_predictions
from .forecast import forecast
from .models import Trained, score, scoring_pipelines, train_models


@dataclass(frozen=True)
class BatchConfig:
    """What the batch job reads, writes and computes."""

    lake: str
    predictions: str | None = None
    models: str | None = None
    city: str | None = None
    limit: int | None = None
    days: int = 7
    scope: str = "per_city"
    split: str = "hash"
    quality: QualityConfig = field(default_factory=QualityConfig)
    features: FeatureConfig = field(default_factory=FeatureConfig)
    model: ModelConfig = field(default_factory=ModelConfig)
    series: SplitConfig = field(default_factory=SplitConfig)


@dataclass
class BatchResult:
    """Outcome of a run; frames are lazy and absent when the job stopped early."""

    gate: Gate
    stopped: str | None = None
    trained: Trained | None = None
    scored: DataFrame | None = None
    metrics: DataFrame | None = None
    future: DataFrame | None = None
    export: DataFrame | None = None

    @property
    def failures(self) -> dict[str, str]:
        """Why a target has no model; such a run is incomplete."""
        return self.trained.failures if self.trained else {}


def split_rows(df: DataFrame, kind: str, config: ModelConfig) -> tuple[DataFrame, DataFrame]:
    if kind == "hash":
        return hash_split(df, config.train_fraction)
    if kind == "random":
        return random_split(df, config.train_fraction, config.seed)
    if kind == "time":
        return time_split(df, config.train_fraction)
    raise ValueError(f"unknown split: {kind}")


def run_batch(spark: SparkSession, config: BatchConfig) -> BatchResult:
    """Run the job on the lake table named by the config."""
    observations = load_observations(spark, config.lake, config.city, config.limit)
    return run_on(observations, config)


def run_on(observations: DataFrame, config: BatchConfig) -> BatchResult:
    """Run the job on a table of clean observations.

    The feature table is staged once: the split, every fit, the scoring and
    the forecast then read only the columns they need from it.
    """
    gate = quality_gate(observations, config.quality)
    if gate.rows == 0 or not gate.passed:
        return BatchResult(gate, stopped=gate.reason or "no observations")

    features = stage(build_features(observations, config.features, split=config.series), "features")
    inputs = feature_names(features)
    train, test = split_rows(complete_rows(features), config.split, config.model)
    if len(train.select("city").take(config.model.min_training_rows)) < config.model.min_training_rows:
        return BatchResult(gate, stopped=f"fewer than {config.model.min_training_rows} training rows")

    trained = train_models(train, inputs, config.model)
    if config.models:
        save_models(scoring_pipelines(trained), config.models)

    scored = stage(score(test, trained), "scored")
    future = forecast(features, inputs, lambda df: score(df, trained), config.days, config.scope)
    export = history_plus_future(scored, future)
    if config.predictions:
        upsert_predictions(export, config.predictions)
    return BatchResult(gate, None, trained, scored, all_metrics(scored), future, export)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Train, evaluate and forecast from the lake.")
    parser.add_argument("lake")
    parser.add_argument("--predictions")
    parser.add_argument("--models")
    parser.add_argument("--city")
    parser.add_argument("--limit", type=int)
    parser.add_argument("--no-save", action="store_true", help="do not save the models")
    args = parser.parse_args(argv)
    spark = build_session("stationflow-batch")
    result = run_batch(
        spark,
        BatchConfig(
            args.lake, args.predictions, None if args.no_save else args.models, args.city, args.limit
        ),
    )
    if result.stopped:
        print(f"stopped: {result.stopped}")
    else:
        result.metrics.show(truncate=False)
    for target, reason in result.failures.items():
        print(f"no model for {target}: {reason}")
    drop_staged(spark)
    if result.failures:
        raise SystemExit(1)


if __name__ == "__main__":
    main()
