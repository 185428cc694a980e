"""Seeded synthetic observations, generated by the executors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Value ranges of the generated measures.
UNIFORM_RANGES = {
    "temperature": (-13.0, 37.0),
    "humidity": (30.0, 95.0),
    "pressure": (1000.0, 1025.0),
    "wind_direction": (0.0, 360.0),
    "wind_speed": (0.0, 15.0),
}
DESCRIPTIONS = ("clear sky", "few clouds", "scattered clouds", "light rain", "moderate rain")


def _pick(options: Sequence[str], seed: int) -> Column:
    index = (F.rand(seed) * len(options)).cast("int") + 1
    return F.element_at(F.array(*map(F.lit, options)), index)


def synthetic_observations(
    spark: SparkSession,
    n: int = 1000,
    cities: Sequence[str] = ("New York",),
    descriptions: Sequence[str] = DESCRIPTIONS,
    start: str = "2016-01-01 00:00:00",
    ranges: dict[str, tuple[float, float]] = UNIFORM_RANGES,
    seed: int = 42,
) -> DataFrame:
    """``n`` hourly raw observations, each for one of ``cities``."""
    hours = F.make_dt_interval(hours=F.col("id").cast("int"))
    stamp = F.date_format(F.lit(start).cast("timestamp") + hours, "yyyy-MM-dd HH:mm:ss")
    measures = {
        name: F.round(F.lit(low) + F.rand(seed + i) * (high - low), 2)
        for i, (name, (low, high)) in enumerate(ranges.items())
    }
    return spark.range(n).select(
        stamp.alias("datetime"),
        _pick(cities, seed + 100).alias("City"),
        measures["temperature"].alias("temperature"),
        measures["humidity"].alias("humidity"),
        measures["pressure"].alias("pressure"),
        _pick(descriptions, seed + 200).alias("weather_desc"),
        measures["wind_direction"].alias("wind_direction"),
        measures["wind_speed"].alias("wind_speed"),
    )
