"""The model feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import MEASURES, FeatureConfig, SplitConfig
from ..functions import calendar, scores
from .series import over_series

# Columns that are never model inputs, besides the targets.
NOT_FEATURES = (
    "datetime", "city", "weather_desc", "weather_desc_clean",
    "season", "pressure_tendency", "precip_intensity",
)
NUMERIC = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType)


def lag_columns(window: WindowSpec, measures: Sequence[str], lags: Sequence[int]) -> dict[str, Column]:
    return {f"{m}_lag_{n}h": F.lag(m, n).over(window) for m in measures for n in lags}


def rolling_columns(window: WindowSpec, measures: Sequence[str], sizes: Sequence[int]) -> dict[str, Column]:
    """Mean and sample deviation over ``size`` earlier rows and the current one.

    Wind measures also get the maximum (gusts).
    """
    columns = {}
    for m in measures:
        for size in sizes:
            frame = window.rowsBetween(-size, 0)
            columns[f"{m}_rolling_mean_{size}h"] = F.avg(m).over(frame)
            columns[f"{m}_rolling_std_{size}h"] = F.stddev_samp(m).over(frame)
            if "wind" in m:
                columns[f"{m}_rolling_max_{size}h"] = F.max(m).over(frame)
    return columns


def present(df: DataFrame, measures: Sequence[str]) -> list[str]:
    return [m for m in measures if m in df.columns]


def with_calendar(df: DataFrame) -> DataFrame:
    return df.withColumns(calendar.calendar_columns(F.col("datetime")))


def with_lags(
    df: DataFrame,
    config: FeatureConfig = FeatureConfig(),
    tie: Sequence[str] = (),
    split: SplitConfig = SplitConfig(),
) -> DataFrame:
    measures = present(df, config.measures)
    return over_series(
        df, lambda w: lag_columns(w, measures, config.lags), max(config.lags), tie=tie, split=split
    )


def with_rolling(
    df: DataFrame,
    config: FeatureConfig = FeatureConfig(),
    tie: Sequence[str] = (),
    split: SplitConfig = SplitConfig(),
) -> DataFrame:
    measures = present(df, config.measures)
    return over_series(
        df, lambda w: rolling_columns(w, measures, config.windows), max(config.windows), tie=tie, split=split
    )


def with_derived(df: DataFrame) -> DataFrame:
    """Columns that combine measures and lags already present."""
    has = set(df.columns).issuperset
    columns = {}
    if has({"temperature", "temperature_lag_1h"}):
        columns["temp_change_1h"] = F.col("temperature") - F.col("temperature_lag_1h")
    if has({"pressure", "pressure_lag_3h"}):
        columns["pressure_tendency"] = scores.pressure_tendency(F.col("pressure"), F.col("pressure_lag_3h"))
    if has({"temperature", "humidity"}):
        columns["heat_index"] = scores.heat_index(F.col("temperature"), F.col("humidity"))
    if has({"temperature", "wind_speed"}):
        columns["wind_chill"] = scores.wind_chill(F.col("temperature"), F.col("wind_speed"))
    return df.withColumns(columns) if columns else df


def build_features(
    df: DataFrame,
    config: FeatureConfig = FeatureConfig(),
    tie: Sequence[str] = (),
    split: SplitConfig = SplitConfig(),
) -> DataFrame:
    """Calendar, lag, rolling and derived columns: one shuffle for all windows."""
    measures = present(df, config.measures)

    def columns(window):
        return lag_columns(window, measures, config.lags) | rolling_columns(window, measures, config.windows)

    return with_calendar(over_series(df, columns, config.lookback, tie=tie, split=split)).transform(with_derived)


def feature_names(df: DataFrame, exclude_targets: bool = True, also: Sequence[str] = ()) -> list[str]:
    """Numeric columns usable as model inputs, by schema only."""
    skip = {*NOT_FEATURES, *also, *(MEASURES if exclude_targets else ())}
    return [f.name for f in df.schema if f.name not in skip and isinstance(f.dataType, NUMERIC)]
