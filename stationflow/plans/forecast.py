"""Seven-day persistence forecast."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from ..config import TARGETS
from ..operators.clean import complete_rows
from ..operators.combine import expand_horizon, latest_overall, latest_per_city


def last_known(
    features: DataFrame, inputs: Sequence[str], scope: str = "per_city", carry: Sequence[str] = ()
) -> DataFrame:
    """Newest row with complete inputs, of every station or of the whole table.

    Only the key, the inputs and the columns in ``carry`` are kept.
    """
    if scope not in ("per_city", "global"):
        raise ValueError(f"unknown forecast scope: {scope}")
    usable = complete_rows(features.select("datetime", "city", *inputs, *carry), inputs)
    return latest_per_city(usable) if scope == "per_city" else latest_overall(usable)


def forecast(
    features: DataFrame,
    inputs: Sequence[str],
    scorer: Callable[[DataFrame], DataFrame],
    days: int = 7,
    scope: str = "per_city",
    keep_time: bool = False,
    targets: Sequence[str] = TARGETS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``datetime, city, prediction_*`` for the next ``days`` days.

    The inputs persist, so each station is scored once and then repeated.
    """
    scored = scorer(last_known(features, inputs, scope, carry))
    predictions = [f"prediction_{t}" for t in targets if f"prediction_{t}" in scored.columns]
    return expand_horizon(scored.select("datetime", "city", *predictions), days, keep_time)
