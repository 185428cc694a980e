"""Canonical table shapes."""

from __future__ import annotations

from pyspark.sql import types as T

from .config import MEASURES

# The wire record: ``datetime`` is text and the station key is spelled ``City``.
RAW_OBSERVATION = T.StructType(
    [
        T.StructField("datetime", T.StringType()),
        T.StructField("City", T.StringType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("humidity", T.DoubleType()),
        T.StructField("pressure", T.DoubleType()),
        T.StructField("weather_desc", T.StringType()),
        T.StructField("wind_direction", T.DoubleType()),
        T.StructField("wind_speed", T.DoubleType()),
    ]
)

OBSERVATION = T.StructType(
    [
        T.StructField("datetime", T.TimestampType()),
        T.StructField("city", T.StringType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("humidity", T.DoubleType()),
        T.StructField("pressure", T.DoubleType()),
        T.StructField("weather_desc", T.StringType()),
        T.StructField("wind_direction", T.DoubleType()),
        T.StructField("wind_speed", T.DoubleType()),
    ]
)

PREDICTION = T.StructType(
    [T.StructField("datetime", T.TimestampType()), T.StructField("city", T.StringType())]
    + [T.StructField(m, T.DoubleType()) for m in MEASURES]
    + [T.StructField("weather_desc", T.StringType())]
    + [T.StructField(f"prediction_{m}", T.DoubleType()) for m in MEASURES]
    + [
        T.StructField("prediction_weather_desc", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

CURRENT_STATE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("reading", OBSERVATION),
        T.StructField("value", T.StringType()),
        T.StructField("written_at", T.TimestampType()),
    ]
)


def jdbc_column_types(schema: T.StructType, text: str = "VARCHAR(255)") -> str:
    """DDL overrides for the JDBC writer, so text columns can be keys."""
    return ", ".join(
        f"{f.name} {text}" for f in schema if isinstance(f.dataType, T.StringType)
    )
