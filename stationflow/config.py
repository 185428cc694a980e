"""Settings that define results (thresholds, feature sizes, model parameters)."""

from __future__ import annotations

from dataclasses import dataclass, field

MEASURES = ("temperature", "humidity", "pressure", "wind_speed", "wind_direction")
CATEGORY = "weather_desc"
TARGETS = MEASURES + (CATEGORY,)


@dataclass(frozen=True)
class RangeRule:
    """A closed interval one column has to lie in; an open end is ``None``."""

    column: str
    low: float | None = None
    high: float | None = None

    @property
    def name(self) -> str:
        return f"{self.column}_range"


# Plausibility limits of the five measures.
RANGE_RULES = (
    RangeRule("temperature", -50.0, 60.0),
    RangeRule("humidity", 0.0, 100.0),
    RangeRule("pressure", 800.0, 1200.0),
    RangeRule("wind_speed", 0.0, None),
    RangeRule("wind_direction", 0.0, 360.0),
)


@dataclass(frozen=True)
class FeatureConfig:
    """Row lags and rolling widths of the feature table."""

    measures: tuple[str, ...] = MEASURES
    lags: tuple[int, ...] = (1, 3, 6, 12, 24)
    windows: tuple[int, ...] = (6, 12, 24)

    @property
    def lookback(self) -> int:
        """Rows before the current one that any feature reads."""
        return max((*self.lags, *self.windows))


@dataclass(frozen=True)
class QualityConfig:
    """Thresholds and penalties of the quality score."""

    required: tuple[str, ...] = TARGETS
    max_missing_fraction: float = 0.2
    min_days: int = 1
    min_rows: int = 50
    penalty_absent_column: float = 20.0
    penalty_missing_values: float = 5.0
    penalty_short_span: float = 15.0
    penalty_few_rows: float = 30.0
    gate_score: float = 50.0
    good_from: float = 80.0
    acceptable_from: float = 60.0


@dataclass(frozen=True)
class ModelConfig:
    """Learners per target and their parameters.

    ``parallelism`` is the number of targets fitted at the same time; a text target
    with more than ``most_labels`` distinct values is not a category and fails.
    """

    seed: int = 42
    train_fraction: float = 0.8
    gbt_iterations: int = 50
    gbt_depth: int = 5
    gbt_step: float = 0.1
    forest_trees: int = 50
    forest_depth: int = 8
    min_training_rows: int = 50
    most_labels: int = 1_000
    parallelism: int = 6
    learners: dict[str, str] = field(
        default_factory=lambda: {
            "temperature": "gbt",
            "humidity": "gbt",
            "pressure": "gbt",
            "wind_speed": "forest",
            "wind_direction": "forest",
            "weather_desc": "forest_classifier",
        }
    )


@dataclass(frozen=True)
class StateConfig:
    """Key layout and lifetime of the current-reading table."""

    prefix: str = "weather:current"
    ttl_seconds: int = 3600


@dataclass(frozen=True)
class SketchConfig:
    """Size of quantile sketches: exact up to ``k`` values, beyond that a rank errs by about 2.5 / k."""

    k: int = 4096


@dataclass(frozen=True)
class SplitConfig:
    """How many consecutive rows, or hours, of one series a task holds at a time."""

    rows_per_segment: int = 1_000_000
    hours_per_segment: int = 24 * 366
