"""Risk scores and comfort indices.

Each score is an ordered list of (condition, points); the first condition that
holds decides, and a null measure satisfies none of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keyword groups and their points, strongest first.
KEYWORD_POINTS = (
    (("hurricane", "tornado"), 50),
    (("storm", "thunder"), 30),
    (("snow", "rain"), 15),
)
# Score floors of the alert levels.
LEVEL_FLOORS = (("CRITICAL", 70), ("HIGH", 40), ("MEDIUM", 20))


def _first_match(cases: Sequence[tuple[Column, object]], default: object) -> Column:
    (test, value), *rest = cases
    chain = F.when(test, value)
    for test, value in rest:
        chain = chain.when(test, value)
    return chain.otherwise(default)


def wind_score(speed: Column) -> Column:
    """40 / 30 beyond 100 / 50, a ramp from 20 on, negative speeds as calm."""
    wind = F.when(speed < 0, F.lit(0.0)).otherwise(speed)
    return _first_match(
        [(wind > 100, F.lit(40.0)), (wind > 50, F.lit(30.0)), (wind > 20, (wind - 20) * 0.5 + 10)],
        F.lit(0.0),
    )


def temperature_score(temperature: Column) -> Column:
    severe = (temperature < -10) | (temperature > 45)
    notable = (temperature < 0) | (temperature > 35)
    return _first_match([(severe, 30), (notable, 15)], 0)


def pressure_score(pressure: Column) -> Column:
    return _first_match([(pressure < 980, 30), (pressure < 1000, 15)], 0)


def keyword_score(description: Column) -> Column:
    text = F.lower(description)
    cases = []
    for words, points in KEYWORD_POINTS:
        test = text.contains(words[0])
        for word in words[1:]:
            test = test | text.contains(word)
        cases.append((test, points))
    return _first_match(cases, 0)


def risk_score(temperature: Column, pressure: Column, wind_speed: Column, description: Column) -> Column:
    """Sum of the four scores, at most 100."""
    total = (
        wind_score(wind_speed)
        + temperature_score(temperature)
        + pressure_score(pressure)
        + keyword_score(description)
    )
    return F.least(F.lit(100.0), total)


def emergency_level(score: Column) -> Column:
    return _first_match([(score >= floor, name) for name, floor in LEVEL_FLOORS], "LOW")


def heat_index_c(temperature: Column, humidity: Column) -> Column:
    """Effective temperature, from 25 degrees on."""
    felt = temperature + 0.55 * (1 - 0.01 * humidity) * (temperature - 14.5)
    return F.when(temperature >= 25, felt).otherwise(temperature)


def wind_chill_c(temperature: Column, wind_speed: Column) -> Column:
    """North American wind chill, for at most 10 degrees and more than 5 km/h."""
    flow = F.pow(wind_speed, F.lit(0.16))
    felt = 13.12 + 0.6215 * temperature - 11.37 * flow + 0.3965 * temperature * flow
    return F.when((temperature <= 10) & (wind_speed > 5), felt).otherwise(temperature)


def heat_index(temperature: Column, humidity: Column) -> Column:
    """Linear variant used as a model feature."""
    return temperature + 0.05 * humidity * (temperature - 20)


def wind_chill(temperature: Column, wind_speed: Column) -> Column:
    """Linear variant used as a model feature."""
    cold = (temperature < 10) & (wind_speed > 5)
    return F.when(cold, temperature - 0.4 * wind_speed).otherwise(temperature)


def pressure_tendency(pressure: Column, earlier: Column) -> Column:
    """Trend against an earlier reading; no earlier reading counts as stable."""
    change = pressure - earlier
    return _first_match([(change > 2, "rising"), (change < -2, "falling")], "stable")
