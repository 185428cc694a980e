"""Wide per-measure tables -> one long, aligned and filled observation table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import SplitConfig
from ..functions.text import to_number, to_timestamp
from .series import fill_series

# Fixed value: offset between the Kelvin and Celsius scales.
KELVIN_OFFSET = 273.15
TEXT_MEASURES = ("weather_desc",)


def unpivot_measure(wide: DataFrame, measure: str) -> DataFrame:
    """One column per station -> rows ``(datetime, City, measure)``, nulls kept."""
    stations = [c for c in wide.columns if c != "datetime"]
    kind = "string" if measure in TEXT_MEASURES else "double"
    typed = wide.select(
        to_timestamp("datetime", wide.schema["datetime"].dataType).alias("datetime"),
        *[
            (F.col(f"`{s}`").cast("string") if kind == "string" else _number(wide, s)).alias(s)
            for s in stations
        ],
    )
    return typed.unpivot("datetime", [F.col(f"`{s}`") for s in stations], "City", measure)


def _number(wide: DataFrame, station: str):
    if isinstance(wide.schema[station].dataType, T.DoubleType):
        return F.col(f"`{station}`")
    return F.col(f"`{station}`").try_cast("double")


def align_measures(wide_tables: Mapping[str, DataFrame]) -> DataFrame:
    """Full outer alignment of all measures on ``(datetime, City)``.

    The long tables are stacked with null for the measures they do not carry
    and collapsed by one grouped aggregation: one shuffle instead of one per
    join. Keys are unique within a measure, so ``max`` only skips the nulls.
    A measure without a table yields no column.
    """
    measures = list(wide_tables)
    kinds = {m: "string" if m in TEXT_MEASURES else "double" for m in measures}
    long = [
        unpivot_measure(wide, m).select(
            "datetime",
            "City",
            *[F.col(o) if o == m else F.lit(None).cast(kinds[o]).alias(o) for o in measures],
        )
        for m, wide in wide_tables.items()
    ]
    stacked = reduce(DataFrame.union, long)
    return stacked.groupBy("datetime", "City").agg(*[F.max(m).alias(m) for m in measures])


def kelvin_to_celsius(df: DataFrame, column: str = "temperature") -> DataFrame:
    """Subtract the offset, two decimals half even; absent column: unchanged."""
    if column not in df.columns:
        return df
    number = to_number(column, df.schema[column].dataType)
    return df.withColumn(column, F.bround(number - F.lit(KELVIN_OFFSET), 2))


def ingest_wide(
    wide_tables: Mapping[str, DataFrame],
    fill: Sequence[str] | None = None,
    split: SplitConfig = SplitConfig(),
) -> DataFrame:
    """Unpivot, align, convert and fill; order it at the sink with ``by_time``."""
    aligned = kelvin_to_celsius(align_measures(wide_tables))
    columns = list(fill) if fill is not None else list(wide_tables)
    return fill_series(aligned, columns, key="City", split=split)


def by_time(df: DataFrame) -> DataFrame:
    """Total order by time, then station."""
    return df.orderBy("datetime", "City" if "City" in df.columns else "city")


def ingest_report(df: DataFrame) -> DataFrame:
    """One row: number of readings and of stations."""
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("City" if "City" in df.columns else "city").alias("n_cities"),
    )
