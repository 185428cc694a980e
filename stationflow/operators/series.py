"""Windows over a station's series that no single task has to hold.

A window partitioned by station puts all rows of that station into one task.
The functions here give the same values as that window, but cut every series at
row positions: the table is range-partitioned and sorted by station and time, which
also splits a single day of a single station, and stored with each row's place in
its range. Places and the sizes of the ranges give the row's number in the whole
sorted table, and a segment is ``rows_per_segment`` consecutive numbers. So the
windows need one shuffle, by station and segment.

* ``over_series`` gives each segment copies of as many preceding rows as its
  frames can read;
* ``fill_series`` carries the last and first known values across segments
  through a small per-segment table.

There is one plan at every size.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..config import SplitConfig
from ..session import stage

SeriesColumns = Callable[[WindowSpec], Mapping[str, Column]]


#: Bits of a generated id that count rows within a task.
_PLACE_BITS = 33


def with_positions(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Add ``_row``: each row's number, from 0, in the table sorted by ``key`` and ``order``.

    The rows of a key are consecutive. The ranges are stored, because they come
    from a sample and their sizes must belong to the same ranges as the rows. No
    shuffle follows: there is one size per range, few enough to be sent to all.
    """
    columns = [F.col(c) for c in (key, *order)]
    sorted_ranges = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
    ranges = stage(sorted_ranges.withColumn("_place", F.monotonically_increasing_id()), "ranges")
    number = F.shiftright("_place", _PLACE_BITS)
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranges.groupBy(number.alias("_range")).agg(F.count("*").alias("_n"))
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    within = F.col("_place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return (
        ranges.withColumn("_range", number)
        .join(F.broadcast(starts), "_range")
        .select(*df.columns, (F.col("_start") + within).alias("_row"))
    )


def segment_of(position: Column, split: SplitConfig) -> Column:
    return F.floor(position / split.rows_per_segment)


def over_series(
    df: DataFrame,
    columns: SeriesColumns,
    lookback: int,
    key: str = "city",
    time: str = "datetime",
    tie: Sequence[str] = (),
    split: SplitConfig = SplitConfig(),
) -> DataFrame:
    """Add columns computed over one station's rows in time order.

    ``columns`` gets the window (partitioned and ordered, no frame) and returns
    the new columns; their frames and lags must stay within ``lookback``
    preceding rows and must not look ahead. No task holds more than
    ``rows_per_segment + lookback`` rows of a station at a time; rows that agree
    in time and ``tie`` stand in any, but one, order.
    """
    row = F.col("_row")
    needed_by = F.sequence(segment_of(row, split), segment_of(row + lookback, split))
    placed = with_positions(df, key, [time, *tie]).select("*", F.posexplode(needed_by).alias("_copy", "_segment"))
    window = Window.partitionBy(key, "_segment").orderBy("_row")
    return placed.withColumns(dict(columns(window))).filter("_copy = 0").drop("_row", "_copy", "_segment")


def fill_series(
    df: DataFrame,
    columns: Sequence[str],
    key: str = "city",
    time: str = "datetime",
    split: SplitConfig = SplitConfig(),
) -> DataFrame:
    """Nulls take the station's last known value, leading nulls its first one.

    Both frames are linear in the series: a leading null has no known value
    before it, so the next one is simply the first of the whole series.
    """

    def last_known(column: str, window: WindowSpec, end: int) -> Column:
        return F.last(column, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, end))

    def first_known(column: str, window: WindowSpec) -> Column:
        whole = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return F.first(column, ignorenulls=True).over(whole)

    placed = with_positions(df, key, [time]).withColumn("_segment", segment_of(F.col("_row"), split))
    known = [
        agg
        for c in columns
        for agg in (
            F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_row"))).alias(f"_first_{c}"),
            F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_row"))).alias(f"_last_{c}"),
        )
    ]
    in_order = Window.partitionBy(key).orderBy("_segment")
    carried = (
        placed.groupBy(key, "_segment")
        .agg(*known)
        .select(
            F.col(key).alias("_key"),
            F.col("_segment").alias("_at"),
            *[last_known(f"_last_{c}", in_order, -1).alias(f"_before_{c}") for c in columns],
            *[first_known(f"_first_{c}", in_order).alias(f"_start_{c}") for c in columns],
        )
    )
    window = Window.partitionBy(key, "_segment").orderBy("_row")
    filled = {c: F.coalesce(f"_back_{c}", f"_before_{c}", f"_start_{c}").alias(c) for c in columns}
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_segment") == F.col("_at"))
    return (
        placed.withColumns({f"_back_{c}": last_known(c, window, 0) for c in columns})
        .join(carried, same, "left")
        .select(*[filled.get(c, F.col(c)) for c in df.columns])
    )
