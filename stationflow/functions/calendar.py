"""Calendar parts of an observation time (session time zone)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Months of each season; every other month is fall.
SEASON_MONTHS = {"winter": (12, 1, 2), "spring": (3, 4, 5), "summer": (6, 7, 8)}


def season(month: Column) -> Column:
    chain = None
    for name, months in SEASON_MONTHS.items():
        test = month.isin(*months)
        chain = F.when(test, name) if chain is None else chain.when(test, name)
    return chain.otherwise("fall")


def cyclic(position: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a position on a circle of ``period`` steps."""
    angle = position * F.lit(2 * math.pi) / F.lit(period)
    return F.sin(angle), F.cos(angle)


def daytime_flag(hour: Column) -> Column:
    """1 from 06:00 to 18:59, else 0."""
    return F.when(hour.between(6, 18), 1).otherwise(0)


def calendar_columns(time: Column) -> dict[str, Column]:
    """The eight calendar features by output name."""
    hour, month = F.hour(time), F.month(time)
    hour_sin, hour_cos = cyclic(hour, 24)
    month_sin, month_cos = cyclic(month - 1, 12)
    return {
        "hour_of_day": hour,
        "day_of_week": F.dayofweek(time),
        "month_of_year": month,
        "season": season(month),
        "hour_sin": hour_sin,
        "hour_cos": hour_cos,
        "month_sin": month_sin,
        "month_cos": month_cos,
    }
