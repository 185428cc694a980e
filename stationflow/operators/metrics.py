"""Forecast accuracy, all targets in one aggregation each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CATEGORY, MEASURES


def _pairs(df: DataFrame, targets: Sequence[str]) -> list[str]:
    has = set(df.columns)
    return [t for t in targets if t in has and f"prediction_{t}" in has]


def _usable(target: str) -> Column:
    """Both values there and numbers."""
    y, p = F.col(target), F.col(f"prediction_{target}")
    return y.isNotNull() & p.isNotNull() & ~F.isnan(y) & ~F.isnan(p)


def regression_metrics(df: DataFrame, targets: Sequence[str] = MEASURES) -> DataFrame:
    """``target, rmse, mae, r2, mape, sample_count``; targets without pairs are left out.

    One pass over the table: the total sum of squares comes from the population
    variance, which Spark merges stably, so no second pass needs the mean.
    """
    present = _pairs(df, targets)
    aggregates = []
    for t in present:
        y = F.when(_usable(t), F.col(t))
        error = F.when(_usable(t), F.col(t) - F.col(f"prediction_{t}"))
        aggregates += [
            F.count(y).alias(f"n_{t}"),
            F.sum(error * error).alias(f"sse_{t}"),
            F.avg(F.abs(error)).alias(f"mae_{t}"),
            F.var_pop(y).alias(f"var_{t}"),
            F.avg(F.abs(error / (F.abs(y) + 0.001))).alias(f"ape_{t}"),
        ]
    rows = [
        F.struct(
            F.lit(t).alias("target"),
            F.sqrt(F.try_divide(F.col(f"sse_{t}"), F.col(f"n_{t}"))).alias("rmse"),
            F.col(f"mae_{t}").alias("mae"),
            (1 - F.try_divide(F.col(f"sse_{t}"), F.col(f"var_{t}") * F.col(f"n_{t}"))).alias("r2"),
            (F.col(f"ape_{t}") * 100).alias("mape"),
            F.col(f"n_{t}").alias("sample_count"),
        )
        for t in present
    ]
    if not rows:
        empty = "target string, rmse double, mae double, r2 double, mape double, sample_count bigint"
        return df.sparkSession.createDataFrame([], empty)
    return df.agg(*aggregates).select(F.inline(F.array(*rows))).filter("sample_count > 0")


def classification_metrics(df: DataFrame, target: str = CATEGORY) -> DataFrame:
    """``target, accuracy, f1, precision, recall, sample_count`` weighted by support.

    Rows collapse to the confusion counts (classes squared) before anything
    else; the per-class and final sums work on those.
    """
    y, p = F.col(target), F.col(f"prediction_{target}")
    counts = (
        df.filter(y.isNotNull() & p.isNotNull())
        .groupBy(y.alias("actual"), p.alias("predicted"))
        .agg(F.count("*").alias("n"))
    )
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    per_class = (
        counts.select(
            F.inline(
                F.array(
                    F.struct(F.col("actual").alias("label"), F.col("n").alias("support"),
                             F.lit(0).cast("bigint").alias("claimed"), hit.alias("hits")),
                    F.struct(F.col("predicted").alias("label"), F.lit(0).cast("bigint").alias("support"),
                             F.col("n").alias("claimed"), F.lit(0).cast("bigint").alias("hits")),
                )
            )
        )
        .groupBy("label")
        .agg(F.sum("support").alias("support"), F.sum("claimed").alias("claimed"), F.sum("hits").alias("hits"))
    )
    zero = F.lit(0.0)
    precision = F.coalesce(F.try_divide("hits", "claimed"), zero)
    recall = F.coalesce(F.try_divide("hits", "support"), zero)
    f1 = F.coalesce(F.try_divide(F.lit(2.0) * F.col("hits"), F.col("support") + F.col("claimed")), zero)

    def weighted(c: Column) -> Column:
        return F.sum(c * F.col("support")) / F.sum("support")

    return (
        per_class.agg(
            (F.sum("hits") / F.sum("support")).alias("accuracy"),
            weighted(f1).alias("f1"),
            weighted(precision).alias("precision"),
            weighted(recall).alias("recall"),
            F.sum("support").alias("sample_count"),
        )
        .filter("sample_count > 0")
        .select(F.lit(target).alias("target"), "accuracy", "f1", "precision", "recall", "sample_count")
    )


METRIC_NAMES = ("rmse", "mae", "r2", "mape", "accuracy", "f1", "precision", "recall")


def all_metrics(
    df: DataFrame, measures: Sequence[str] = MEASURES, category: str | None = CATEGORY
) -> DataFrame:
    """One row per target with the metrics of its kind; others are null."""
    table = regression_metrics(df, measures)
    if category and _pairs(df, [category]):
        table = table.unionByName(classification_metrics(df, category), allowMissingColumns=True)
    present = [c for c in METRIC_NAMES if c in table.columns]
    return table.select(
        "target",
        *[(F.col(c) if c in present else F.lit(None).cast("double")).alias(c) for c in METRIC_NAMES],
        "sample_count",
    )


def accuracy_band(r2: Column) -> Column:
    return F.when(r2 >= 0.8, "good").when(r2 >= 0.5, "fair").otherwise("poor")


def accuracy_bands(metrics: DataFrame) -> DataFrame:
    """Targets that have an R², with its traffic-light band."""
    return metrics.filter("r2 IS NOT NULL").select("target", "r2", accuracy_band(F.col("r2")).alias("band"))
