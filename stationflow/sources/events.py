"""Observations derived from the ``events`` table.

The given tables hold no weather, so every event becomes one raw reading by a
fixed arithmetic mapping that makes each range rule reject some rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Description text of each event type; others have none.
DESCRIPTION_OF_TYPE = {
    "click": " clear sky ",
    "error": "Thunderstorm",
    "purchase": "light RAIN",
    "signup": "hurricane watch",
}


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def events_as_observations(
    events: DataFrame, stations: int | None = None, keep: Sequence[str] = ("event_id",), users: int = 1
) -> DataFrame:
    """Raw observations plus the event columns in ``keep``.

    Every ``users`` users are a station; several of them make copies of each
    (hour, station), and the number of stations grows with the table. ``stations`` folds them
    into a fixed number instead, for tables with a column per station.
    """
    number = F.floor(F.col("user_id") / users) if stations is None else F.col("user_id") % stations
    kind = F.col("event_type")
    text = F.lit(None).cast("string")
    for name, description in DESCRIPTION_OF_TYPE.items():
        text = F.when(kind == name, description).otherwise(text)
    event = F.col("event_id")
    return events.select(
        *keep,
        F.date_format(F.date_trunc("hour", F.col("ts").cast("timestamp")), "yyyy-MM-dd HH:mm:ss").alias("datetime"),
        F.concat(F.lit("  city "), number.cast("string"), F.lit(" ")).alias("City"),
        ((event * 37 % 1290).cast("double") / 10 - 58).alias("temperature"),
        (F.get_json_object("props", "$.k").cast("double") * 1.1).alias("humidity"),
        (event % 421 + 790).cast("double").alias("pressure"),
        text.alias("weather_desc"),
        (event * 13 % 370).cast("double").alias("wind_direction"),
        (event * 7 % 125 - 3).cast("double").alias("wind_speed"),
    )
