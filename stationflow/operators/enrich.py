"""Risk, comfort and short-trend columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SplitConfig
from ..functions import scores
from ..functions.calendar import daytime_flag
from .series import over_series


def with_risk(df: DataFrame) -> DataFrame:
    """``disaster_risk_score`` (0..100) and its ``emergency_level``."""
    score = scores.risk_score(*map(F.col, ("temperature", "pressure", "wind_speed", "weather_desc")))
    return df.withColumn("disaster_risk_score", score).withColumn(
        "emergency_level", scores.emergency_level(F.col("disaster_risk_score"))
    )


def with_comfort(df: DataFrame) -> DataFrame:
    """Heat index, wind chill, hour and the daytime flag."""
    temperature, hour = F.col("temperature"), F.hour("datetime")
    return df.withColumns(
        {
            "heat_index_c": scores.heat_index_c(temperature, F.col("humidity")),
            "wind_chill_c": scores.wind_chill_c(temperature, F.col("wind_speed")),
            "hour": hour,
            "is_daytime": daytime_flag(hour),
        }
    )


def with_trend(
    df: DataFrame, tie: Sequence[str] = (), split: SplitConfig = SplitConfig()
) -> DataFrame:
    """Change since the previous reading and the three-reading mean pressure."""

    def columns(window):
        previous = F.lag("temperature", 1).over(window)
        return {
            "temp_lag_1": previous,
            "temp_change": F.col("temperature") - previous,
            "pressure_rolling_avg": F.avg("pressure").over(window.rowsBetween(-2, 0)),
        }

    return over_series(df, columns, lookback=2, tie=tie, split=split)
