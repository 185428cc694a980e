"""Newest reading per station in the state store, forgotten after a lifetime of event time.

Each station has a value, its newest reading, and a timer at the end of the
reading's life. The stream of changes says when a station gets a newer reading
and when it loses its last one, so a table of live stations can be kept without
looking at stations nothing happens to. All times are event times: a replay gives
the same changes, whatever the clock says.

A station's rows of a micro-batch come in Arrow batches of bounded size, however many there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.clean import valid_observations
from ..operators.normalize import normalize_observations
from ..operators.serving import reading_json
from ..schema import OBSERVATION
from ..sources.readers import decode_messages, read_lake

CHANGE = "city string, micros long, value string, alive boolean"
STATE = "micros long, value string"
CHANGES = T.StructType(
    [
        T.StructField("city", T.StringType()),
        T.StructField("datetime", T.TimestampType()),
        T.StructField("value", T.StringType()),
        T.StructField("alive", T.BooleanType()),
    ]
)


def changes(observations: DataFrame, lifetime_seconds: int, delay: str) -> DataFrame:
    """``city, datetime, value, alive``: every newer reading of a station, and its end of life.

    ``observations`` is a stream of clean rows; ``value`` is the reading as JSON, of equal times the greatest text. A
    reading ends when the watermark, ``delay`` behind the newest row, reaches its time plus the lifetime; what arrives
    later than that is no news. Rows without station are one station.
    """
    life = lifetime_seconds * 1000

    def follow(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        micros, value = state.get if state.exists else (None, None)
        before, now = micros, state.getCurrentWatermarkMs()
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame({"city": [key[0]], "micros": [micros], "value": [value], "alive": [False]})
            return
        for batch in batches:
            newest = batch.sort_values(["micros", "value"]).iloc[-1]
            if micros is None or (newest["micros"], newest["value"]) > (micros, value):
                micros, value = int(newest["micros"]), newest["value"]
        end = micros // 1000 + life
        if end <= now:
            if before is not None:
                state.remove()
                yield pd.DataFrame({"city": [key[0]], "micros": [micros], "value": [value], "alive": [False]})
            return
        changed = not state.exists or tuple(state.get) != (micros, value)
        state.update((micros, value))
        # A timer fires when the watermark has passed it.
        state.setTimeoutTimestamp(max(end - 1, now + 1))
        if changed:
            yield pd.DataFrame({"city": [key[0]], "micros": [micros], "value": [value], "alive": [True]})

    columns = [f.name for f in OBSERVATION if f.name in observations.columns]
    rows = observations.withWatermark("datetime", delay).select("city", "datetime", F.unix_micros("datetime").alias("micros"), reading_json(columns).alias("value"))
    found = rows.groupBy("city").applyInPandasWithState(follow, CHANGE, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return found.select("city", F.timestamp_micros("micros").alias("datetime"), "value", "alive")


def start_change_sink(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    lifetime_seconds: int,
    delay: str,
    every: str | None = "5 seconds",
    name: str | None = None,
) -> StreamingQuery:
    """Append the changes of a stream of messages to a table, exactly once."""
    clean = normalize_observations(valid_observations(decode_messages(messages)))
    writer = changes(clean, lifetime_seconds, delay).writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    return read_lake(spark, path, schema=CHANGES)


def live(changed: DataFrame) -> DataFrame:
    """``city, datetime, value`` of the stations whose last change is a reading."""
    order = F.struct("datetime", ~F.col("alive"), "value")
    last = changed.groupBy("city").agg(F.max_by(F.struct("datetime", "value", "alive"), order).alias("r"))
    return last.filter("r.alive").select("city", "r.datetime", "r.value")
