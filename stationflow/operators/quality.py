"""Data quality: missing values, ranges, span, score and gate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import MEASURES, QualityConfig

SECONDS_PER_DAY = 86_400


def is_missing(name: str, data_type: T.DataType) -> Column:
    """Null, or NaN where the type has one."""
    missing = F.col(name).isNull()
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        missing = missing | F.isnan(name)
    return missing


def profile(df: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    """One row with every count and bound the checks need, in one pass."""
    types = {f.name: f.dataType for f in df.schema}
    aggregates = [
        F.count("*").alias("n_rows"),
        F.min("datetime").alias("first_time"),
        F.max("datetime").alias("last_time"),
    ]
    for c in config.required:
        if c in types:
            aggregates.append(F.count_if(is_missing(c, types[c])).alias(f"missing_{c}"))
    for m in MEASURES:
        if m in types:
            aggregates += [F.min(m).alias(f"min_{m}"), F.max(m).alias(f"max_{m}")]
    return df.agg(*aggregates)


def quality_report(df: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    """One row per required column: presence, missing values, range."""
    wide = profile(df, config)
    absent = F.lit(None).cast("double")
    rows = []
    for c in config.required:
        present = c in df.columns
        count = F.col(f"missing_{c}") if present else F.lit(None).cast("bigint")
        ranged = present and c in MEASURES
        rows.append(
            F.struct(
                F.lit(c).alias("feature"),
                F.lit(present).alias("present"),
                count.alias("missing_count"),
                (F.try_divide(count * F.lit(100.0), F.col("n_rows")) if present else absent).alias("missing_pct"),
                (F.col(f"min_{c}").cast("double") if ranged else absent).alias("min_value"),
                (F.col(f"max_{c}").cast("double") if ranged else absent).alias("max_value"),
            )
        )
    return wide.select(F.inline(F.array(*rows)))


def quality_score(df: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    """One row: size, span in whole days, score and band. An empty table scores 0."""
    wide = profile(df, config)
    rows = F.col("n_rows")
    seconds = F.unix_micros("last_time") - F.unix_micros("first_time")
    days = F.floor(seconds / (SECONDS_PER_DAY * 1_000_000)).cast("int")
    too_many = [
        F.when(F.col(f"missing_{c}") > rows * config.max_missing_fraction, config.penalty_missing_values).otherwise(0.0)
        for c in config.required
        if c in df.columns
    ]
    is_absent = any(c not in df.columns for c in config.required)
    score = F.lit(100.0 - (config.penalty_absent_column if is_absent else 0.0))
    for penalty in too_many:
        score = score - penalty
    score = (
        score
        - F.when(F.col("time_span_days") < config.min_days, config.penalty_short_span).otherwise(0.0)
        - F.when(rows < config.min_rows, config.penalty_few_rows).otherwise(0.0)
    )
    return (
        wide.withColumn("time_span_days", days)
        .withColumn("quality_score", F.when(rows == 0, 0.0).otherwise(score))
        .select(
            F.col("n_rows").alias("total_records"),
            "time_span_days",
            "quality_score",
            quality_band(F.col("quality_score"), config).alias("band"),
        )
    )


def quality_band(score: Column, config: QualityConfig = QualityConfig()) -> Column:
    floored = F.greatest(F.lit(0.0), score)
    return (
        F.when(floored >= config.good_from, "GOOD")
        .when(floored >= config.acceptable_from, "ACCEPTABLE")
        .otherwise("POOR")
    )


@dataclass(frozen=True)
class Gate:
    """Outcome of the checks that stop a job early."""

    passed: bool
    reason: str | None
    score: float
    rows: int


def quality_gate(df: DataFrame, config: QualityConfig = QualityConfig()) -> Gate:
    """Run the score (one row reaches the driver) and decide whether to go on."""
    row = quality_score(df, config).first()
    passed = row["quality_score"] >= config.gate_score
    reason = None if passed else f"quality score {row['quality_score']:.1f} is below {config.gate_score:.1f}"
    return Gate(passed, reason, row["quality_score"], row["total_records"])


def absent_columns(df: DataFrame, config: QualityConfig = QualityConfig()) -> list[str]:
    return [c for c in config.required if c not in df.columns]


def cities(df: DataFrame) -> DataFrame:
    """Distinct stations in order."""
    return df.select("city").distinct().orderBy("city")


def data_summary(df: DataFrame) -> DataFrame:
    """One row: readings, columns, stations."""
    return df.agg(
        F.count("*").alias("total_records"),
        F.lit(len(df.columns)).alias("total_columns"),
        F.count_distinct("city").alias("n_cities"),
    )


def first_cities(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` stations by name, by a top-n rather than one big set."""
    return cities(df).limit(n)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """Some ``n`` rows of a batch table; a stream only has its schema to show."""
    if df.isStreaming:
        df.printSchema()
        return df
    shown = [c for c in ("datetime", "city", *QualityConfig().required) if c in df.columns]
    return df.select(*shown).limit(n)


def row_count(df: DataFrame) -> int | None:
    """Rows of a batch table; unknown (``None``) for a stream."""
    return None if df.isStreaming else df.count()
