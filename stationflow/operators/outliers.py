"""Interquartile-range filter, exact quantiles, imputation."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SketchConfig
from ..session import stage

HISTOGRAM_BINS = 65_536


def _is_number(column: str) -> Column:
    return F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double"))


def exact_quantiles(df: DataFrame, column: str, probabilities: Sequence[float]) -> list[float]:
    """Discrete quantiles (smallest value with at least that share below or at it).

    Empty when the column has no numbers.
    """
    return exact_ranks(df, column, lambda n: [max(1, math.ceil(round(p * n, 9))) for p in probabilities])


def exact_ranks(df: DataFrame, column: str, ranks_of: Callable[[int], Sequence[int]]) -> list[float]:
    """Values at ranks, from 1, of the column's numbers; ``ranks_of`` names them by how many numbers there are.

    Narrows an interval by histograms: each pass is one aggregation returning at
    most ``HISTOGRAM_BINS`` rows, whatever the size of the table, and the next
    pass reads only the bin the rank falls into. Ends when that bin holds one
    distinct value. Empty when the column has no numbers.
    """
    values = df.filter(_is_number(column)).select(F.col(column).cast("double").alias("v"))
    infinite = F.lit(math.inf)
    head = values.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("v") == -infinite).alias("below"),
        F.count_if(F.col("v") == infinite).alias("above"),
        F.min(F.when(F.abs("v") < infinite, F.col("v"))).alias("lo"),
        F.max(F.when(F.abs("v") < infinite, F.col("v"))).alias("hi"),
    ).first()
    if head["n"] == 0:
        return []
    ranks = list(ranks_of(head["n"]))
    found: dict[int, float] = {}
    open_ranks = []
    for rank in set(ranks):
        if rank <= head["below"]:
            found[rank] = -math.inf
        elif rank > head["n"] - head["above"]:
            found[rank] = math.inf
        else:
            open_ranks.append(rank)
    pending = [(head["lo"], head["hi"], head["below"], open_ranks)] if open_ranks else []
    while pending:
        lo, hi, below, wanted = pending.pop()
        if lo == hi:
            found |= dict.fromkeys(wanted, lo)
            continue
        bins = (
            values.filter(F.col("v").between(lo, hi))
            .groupBy(_bin(F.col("v"), lo, hi).alias("bin"))
            .agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
            .collect()
        )
        for row in sorted(bins, key=lambda r: r["bin"]):
            inside = [r for r in wanted if below < r <= below + row["n"]]
            if inside:
                pending.append((row["lo"], row["hi"], below, inside))
            below += row["n"]
    return [found[r] for r in ranks]


def _bin(value: Column, lo: float, hi: float) -> Column:
    width = (hi - lo) / HISTOGRAM_BINS
    if math.isinf(width):
        return F.when(value < 0, 0).otherwise(1).cast("bigint")
    if width == 0:
        return F.when(value == lo, 0).otherwise(1).cast("bigint")
    return F.least(F.floor((value - F.lit(lo)) / F.lit(width)), F.lit(HISTOGRAM_BINS - 1).cast("bigint"))


def value_sketches(
    df: DataFrame, column: str, keys: Sequence[str], config: SketchConfig = SketchConfig()
) -> DataFrame:
    """``keys, n, sketch``: a mergeable quantile sketch of the column's numbers per key.

    A table of such rows can be stored, one per station and day say, and merged
    later by :func:`merge_sketches` without reading the values again. Keys
    without numbers have no row. Partial sketches are merged before and after the shuffle.
    """
    numbers = df.filter(_is_number(column)).withColumn("_v", F.col(column).cast("double"))
    return numbers.groupBy(*keys).agg(F.count("*").alias("n"), F.kll_sketch_agg_double("_v", F.lit(config.k)).alias("sketch"))


def merge_sketches(sketches: DataFrame, keys: Sequence[str], config: SketchConfig = SketchConfig()) -> DataFrame:
    """Sketches of coarser ``keys`` from those of finer ones."""
    return sketches.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(config.k)).alias("sketch"))


def sketch_fences(sketches: DataFrame, reach: float = 1.5) -> DataFrame:
    """Quartiles ``q1, q3`` and fences ``low, high`` of every sketch, in its place."""
    quartile = {q: F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(p))) for q, p in (("q1", 0.25), ("q3", 0.75))}
    margin = F.lit(reach) * (F.col("q3") - F.col("q1"))
    return sketches.withColumns(quartile).drop("sketch").withColumns({"low": F.col("q1") - margin, "high": F.col("q3") + margin})


def fences_by(
    df: DataFrame,
    column: str,
    keys: Sequence[str] = ("city",),
    by: Sequence[str] = (),
    config: SketchConfig = SketchConfig(),
    reach: float = 1.5,
) -> DataFrame:
    """``keys, n, q1, q3, low, high``: fences of every station from one pass over the table.

    With ``by``, e.g. the day, sketches are made for the finer keys first and then merged.
    """
    fine = value_sketches(df, column, [*keys, *by], config)
    return sketch_fences(merge_sketches(fine, keys, config) if by else fine, reach)


#: Stations whose fences are sent to every executor.
MOST_BROADCAST_FENCES = 200_000


def without_outliers_by(
    df: DataFrame, column: str, keys: Sequence[str] = ("city",), config: SketchConfig = SketchConfig(), reach: float = 1.5
) -> DataFrame:
    """Rows within the fences of their own station; rows without a number go, as with one pair of fences.

    The fences are counted first: up to ``MOST_BROADCAST_FENCES`` they go to
    every executor and no row is shuffled for them; beyond, they are joined. A null key is a station too.
    """
    fences = stage(fences_by(df, column, keys, config=config, reach=reach), "fences")
    named = fences.select(*[F.col(k).alias(f"_{k}") for k in keys], "low", "high")
    if fences.count() <= MOST_BROADCAST_FENCES:
        named = F.broadcast(named)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return df.join(named, same).filter(F.col(column).between(F.col("low"), F.col("high"))).select(*df.columns)


def iqr_bounds(df: DataFrame, column: str, error: float = 0.05, sketch: SketchConfig | None = None) -> tuple[float, float] | None:
    """Fences at 1.5 interquartile ranges.

    By exact quartiles with ``error=0``, by a ``sketch`` that is exact up to its size, else within ``error`` of the ranks.
    """
    shares = [0.25, 0.75]
    if sketch:
        row = fences_by(df, column, [], config=sketch).first()
        quartiles = [row["q1"], row["q3"]] if row and row["n"] else []
    else:
        quartiles = df.approxQuantile(column, shares, error) if error > 0 else exact_quantiles(df, column, shares)
    if len(quartiles) < 2:
        return None
    reach = 1.5 * (quartiles[1] - quartiles[0])
    return quartiles[0] - reach, quartiles[1] + reach


def without_outliers(df: DataFrame, column: str, error: float = 0.05, sketch: SketchConfig | None = None) -> DataFrame:
    """Rows within the fences; unchanged when there are no numbers to judge by.

    The fences are two literals, so the filter reaches the Parquet scan.
    """
    bounds = iqr_bounds(df, column, error, sketch) if column in df.columns else None
    return df if bounds is None else df.filter(F.col(column).between(*bounds))


def impute(df: DataFrame, columns: Sequence[str], strategy: str = "mean") -> DataFrame:
    """Replace null and NaN by 0 or by the column's mean.

    For means the table is staged, so that its plan runs once.
    """
    if strategy not in ("zero", "mean"):
        raise ValueError(f"unknown imputation strategy: {strategy}")
    present = [c for c in columns if c in df.columns]
    if strategy == "zero":
        return df.fillna(0.0, subset=present)
    df = stage(df, "imputed")
    means = df.agg(*[F.avg(F.when(_is_number(c), F.col(c))).alias(c) for c in present]).first()
    return df.fillna({c: means[c] for c in present if means[c] is not None})
