"""Stream of messages -> clean readings -> lake and current state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..config import StateConfig
from ..operators.clean import clean_observations
from ..operators.normalize import normalize_observations
from ..sources.readers import decode_messages
from ..sources.sinks import DAY, with_day
from .state import write_state_batch


def clean_stream(messages: DataFrame, delay: str | None = None, spread: int = 1) -> DataFrame:
    """Decode, clean and normalise; runs the same on a batch of messages."""
    return normalize_observations(clean_observations(decode_messages(messages), delay=delay, spread=spread))


def _trigger(writer, every: str | None):
    """Process what is there and stop when ``every`` is ``None``."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def start_lake_sink(
    df: DataFrame, path: str, checkpoint: str, every: str | None = "30 seconds", name: str | None = None
) -> StreamingQuery:
    """Append to a Parquet lake with one folder per day, exactly once."""
    writer = (
        with_day(df)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(DAY)
    )
    if name:
        writer = writer.queryName(name)
    return _trigger(writer, every).start()


def start_state_sink(
    df: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = "5 seconds",
    config: StateConfig = StateConfig(),
    name: str | None = None,
) -> StreamingQuery:
    """Keep the newest reading per station; safe to replay."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_state_batch(batch, batch_id, path, config)

    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    if name:
        writer = writer.queryName(name)
    return _trigger(writer, every).start()


def start_console(df: DataFrame, name: str, rows: int = 10, every: str | None = "10 seconds") -> StreamingQuery:
    """Print rows of each micro-batch, for debugging."""
    writer = (
        df.writeStream.format("console")
        .outputMode("append")
        .queryName(name)
        .option("numRows", rows)
        .option("truncate", False)
    )
    return _trigger(writer, every).start()


def start_etl(
    messages: DataFrame,
    lake: str,
    state: str,
    checkpoints: str,
    delay: str | None = None,
    spread: int = 1,
    lake_every: str | None = "30 seconds",
    state_every: str | None = "5 seconds",
) -> tuple[StreamingQuery, StreamingQuery]:
    """Both sinks as independent queries: the lake exactly once, the state idempotent."""
    clean = clean_stream(messages, delay, spread)
    return (
        start_lake_sink(clean, lake, f"{checkpoints}/lake", lake_every, name="lake_sink"),
        start_state_sink(clean, state, f"{checkpoints}/state", state_every, name="state_sink"),
    )
