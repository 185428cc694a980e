"""Read-side queries over the prediction and current-reading tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import CATEGORY, MEASURES, StateConfig
from ..functions.text import city_of_key, title_words
from ..schema import OBSERVATION
from .combine import with_category_codes

# Names the dashboard reads, by stored name, in display order.
SERVING_NAMES = {
    "datetime": "datetime",
    "city": "city",
    "temperature": "temp_celsius",
    "humidity": "humidity_pct",
    "wind_speed": "wind_speed_kmh",
    "wind_direction": "wind_direction",
    "prediction_temperature": "prediction_temp_celsius",
    "prediction_humidity": "prediction_humidity_pct",
    "prediction_wind_speed": "prediction_wind_speed_kmh",
    "prediction_wind_direction": "prediction_wind_direction",
    "prediction_weather_desc": "prediction_weather_condition",
}
# Labels of the forecast table.
DISPLAY_LABELS = {
    "datetime": "Time",
    "prediction_weather_condition": "Condition",
    "prediction_temp_celsius": "Temp (°C)",
    "prediction_humidity_pct": "Humidity (%)",
    "prediction_wind_speed_kmh": "Wind Spd (km/h)",
    "prediction_wind_direction": "Wind Dir (°)",
}
# Measures of the error summary and of the gauges with their full scale.
SUMMARY_PAIRS = ("temp_celsius", "humidity_pct", "wind_speed_kmh", "wind_direction")
GAUGE_MAXIMA = {"temperature": 50.0, "humidity": 100.0, "wind_speed": 100.0}


def available_cities(predictions: DataFrame) -> DataFrame:
    return predictions.select("city").distinct().orderBy("city")


def serving_view(predictions: DataFrame) -> DataFrame:
    """Stored prediction columns under their serving names."""
    return predictions.select(
        *[F.col(stored).alias(name) for stored, name in SERVING_NAMES.items() if stored in predictions.columns]
    )


def latest_predictions(predictions: DataFrame, city: str, limit: int = 336) -> DataFrame:
    """The newest ``limit`` predictions of one station, newest first."""
    chosen = predictions.filter(F.col("city") == city)
    return serving_view(chosen.orderBy(F.col("datetime").desc()).limit(limit))


def latest_predictions_all(predictions: DataFrame, limit: int = 336) -> DataFrame:
    """The newest ``limit`` predictions of every station.

    The rank filter is applied in the map tasks first, so at most ``limit``
    rows per station and task are shuffled.
    """
    newest = Window.partitionBy("city").orderBy(F.col("datetime").desc())
    ranked = predictions.withColumn("_rank", F.row_number().over(newest))
    return serving_view(ranked.filter(F.col("_rank") <= limit))


def error_summary(view: DataFrame, columns: Sequence[str] = SUMMARY_PAIRS) -> DataFrame:
    """One row: mean absolute error per measure over rows having both values."""
    present = [c for c in columns if c in view.columns and f"prediction_{c}" in view.columns]
    return view.agg(*[F.avg(F.abs(F.col(c) - F.col(f"prediction_{c}"))).alias(f"mae_{c}") for c in present])


def display_table(view: DataFrame) -> DataFrame:
    """Forecast columns that exist, minutes precision, under their labels."""
    present = {c: label for c, label in DISPLAY_LABELS.items() if c in view.columns}
    shown = view.select(*present)
    if "datetime" in present:
        shown = shown.withColumn("datetime", F.date_format("datetime", "yyyy-MM-dd HH:mm"))
    return shown.withColumnsRenamed(present)


def actual_vs_predicted(df: DataFrame, targets: Sequence[str] = MEASURES) -> DataFrame:
    """Long series ``city, target, datetime, actual, predicted`` of numeric targets."""
    present = [t for t in targets if f"prediction_{t}" in df.columns]
    points = F.array(
        *[
            F.struct(F.lit(t).alias("target"), F.col(t).alias("actual"), F.col(f"prediction_{t}").alias("predicted"))
            for t in present
        ]
    )
    return df.select("city", "datetime", F.inline(points)).select("city", "target", "datetime", "actual", "predicted")


def category_series(df: DataFrame, target: str = CATEGORY) -> DataFrame:
    """Actual and predicted category codes over time."""
    return with_category_codes(df, target).select("city", "datetime", "actual_code", "predicted_code")


# -- current readings ------------------------------------------------------


def state_key(city: Column, prefix: str = StateConfig.prefix) -> Column:
    return F.concat(F.lit(f"{prefix}:"), F.trim(city))


def reading_json(columns: Sequence[str]) -> Column:
    """A row as JSON text: time as plain text, nulls spelled out."""
    fields = [
        F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if c == "datetime" else F.col(c) for c in columns
    ]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def live_readings(state: DataFrame, now: Column | None = None, config: StateConfig = StateConfig()) -> DataFrame:
    """Entries whose lifetime has not run out."""
    now = F.current_timestamp() if now is None else now
    return state.filter(F.col("written_at") > now - F.make_dt_interval(secs=F.lit(config.ttl_seconds)))


def current_readings(
    state: DataFrame, now: Column | None = None, config: StateConfig = StateConfig()
) -> DataFrame:
    """``key`` and decoded reading of every live station."""
    live = live_readings(state, now, config)
    decoded = live.select("key", F.from_json("value", OBSERVATION).alias("r"))
    return decoded.select("key", "r.*")


def current_reading(
    state: DataFrame,
    city: str | None = None,
    now: Column | None = None,
    config: StateConfig = StateConfig(),
) -> DataFrame:
    """The live reading of one station; without a name, of the first key."""
    readings = current_readings(state, now, config)
    if city is not None:
        return readings.filter(F.col("key") == f"{config.prefix}:{city}")
    return readings.orderBy("key").limit(1)


def reporting_cities(
    state: DataFrame, now: Column | None = None, config: StateConfig = StateConfig()
) -> DataFrame:
    """Stations with a live reading, in order."""
    live = live_readings(state, now, config).select(city_of_key(F.col("key")).alias("city"))
    return live.distinct().orderBy("city")


def reading_cards(readings: DataFrame) -> DataFrame:
    """Display texts of a reading: missing measures as 0, missing condition as unknown."""

    def shown(name: str, pattern: str) -> Column:
        return F.format_string(pattern, F.coalesce(F.col(name), F.lit(0.0)))

    return readings.select(
        "city",
        shown("temperature", "%.1f°C").alias("temperature"),
        shown("humidity", "%.0f%%").alias("humidity"),
        shown("pressure", "%.0f hPa").alias("pressure"),
        title_words(F.coalesce(F.col("weather_desc"), F.lit("unknown"))).alias("condition"),
        shown("wind_speed", "%.1f km/h").alias("wind_speed"),
        shown("wind_direction", "%.0f°").alias("wind_direction"),
        F.date_format("datetime", "HH:mm:ss").alias("last_update"),
    )


def gauge_fractions(readings: DataFrame) -> DataFrame:
    """Measures as shares of the gauges' full scale."""
    return readings.select(
        "city",
        *[
            (F.coalesce(F.col(c), F.lit(0.0)) / top).alias(f"{c}_fraction")
            for c, top in GAUGE_MAXIMA.items()
        ],
    )
