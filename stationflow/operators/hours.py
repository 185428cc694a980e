"""Features over hours instead of rows, for series with gaps.

A lag of three hours is the reading of exactly three hours before, null if there
is none, and a rolling mean covers the readings of its hours, however many there
are. Frames are ranges of time, so a series can be cut at fixed times: a segment
is ``hours_per_segment`` hours of one station, and rows of the last hours a frame
can reach back are copied into the next segment. Where a row goes follows from
the row alone: one shuffle, by station and segment, no sample and no count.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..config import FeatureConfig, SplitConfig
from .features import present

SECONDS = 3600
HourColumns = Callable[[WindowSpec], Mapping[str, Column]]


def over_hours(
    df: DataFrame,
    columns: HourColumns,
    lookback: int,
    key: str = "city",
    time: str = "datetime",
    split: SplitConfig = SplitConfig(),
) -> DataFrame:
    """Add columns computed over one station's rows by time.

    ``columns`` gets a window ordered by seconds; its frames are ranges within
    ``lookback`` hours before the row up to the row. No task holds more of a
    station than ``hours_per_segment + lookback`` hours at a time. Rows without
    time see only each other.
    """
    length = split.hours_per_segment * SECONDS
    second = F.unix_timestamp(time)
    segment, last = F.floor(second / length), F.floor((second + lookback * SECONDS) / length)
    copies = F.when(second.isNull(), F.array(F.lit(None).cast("bigint"))).otherwise(F.sequence(segment, last))
    placed = df.select("*", second.alias("_second"), F.posexplode(copies).alias("_copy", "_segment"))
    window = Window.partitionBy(key, "_segment").orderBy("_second")
    return placed.withColumns(dict(columns(window))).filter("_copy = 0").drop("_second", "_copy", "_segment")


def _reaching(window: WindowSpec, hours: int, until: int = 0) -> WindowSpec:
    return window.rangeBetween(-hours * SECONDS, -until * SECONDS)


def hour_lag_columns(window: WindowSpec, measures: Sequence[str], lags: Sequence[int]) -> dict[str, Column]:
    """The value of exactly ``n`` hours before; of several then, the greatest."""
    return {f"{m}_hour_lag_{n}": F.max(m).over(_reaching(window, n, n)) for m in measures for n in lags}


def hour_rolling_columns(window: WindowSpec, measures: Sequence[str], sizes: Sequence[int]) -> dict[str, Column]:
    """Mean, sample deviation and number of values from ``size`` hours before up to now; wind also the maximum."""
    columns = {}
    for m in measures:
        for size in sizes:
            frame = _reaching(window, size)
            columns[f"{m}_hour_mean_{size}"] = F.avg(m).over(frame)
            columns[f"{m}_hour_std_{size}"] = F.stddev_samp(m).over(frame)
            columns[f"{m}_hour_count_{size}"] = F.count(m).over(frame)
            if "wind" in m:
                columns[f"{m}_hour_max_{size}"] = F.max(m).over(frame)
    return columns


def with_hour_lags(df: DataFrame, config: FeatureConfig = FeatureConfig(), split: SplitConfig = SplitConfig()) -> DataFrame:
    """Readings of exactly the configured hours before."""
    measures = present(df, config.measures)
    return over_hours(df, lambda w: hour_lag_columns(w, measures, config.lags), max(config.lags), split=split)


def with_hour_rolling(df: DataFrame, config: FeatureConfig = FeatureConfig(), split: SplitConfig = SplitConfig()) -> DataFrame:
    """Statistics of the configured numbers of hours."""
    measures = present(df, config.measures)
    return over_hours(df, lambda w: hour_rolling_columns(w, measures, config.windows), max(config.windows), split=split)
