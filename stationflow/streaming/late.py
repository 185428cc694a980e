"""A stream with bounded state that loses no key: late rows get a table of their own.

A watermark bounds the state of the deduplication, and rows that come after it
are dropped there. One query takes the stream twice, with and without that
operator: what comes out of it goes to the lake; keys that went in but are
neither in the lake nor came out are late, and go, once each, to the late table.
Both tables have a folder per day and batch, so a batch that runs again replaces
its own rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import KEYS, dedupe, valid_observations
from ..operators.normalize import normalize_observations
from ..schema import OBSERVATION
from ..sources.readers import decode_messages, read_lake
from ..sources.sinks import DAY, MOST_DAYS, with_day
from .state import BATCH

_KEPT = "_kept"


def with_late_rows(messages: DataFrame, delay: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Clean rows of a stream of messages, each with ``_kept``: true as it leaves the deduplication, false as it came."""
    clean = normalize_observations(valid_observations(decode_messages(messages))).withWatermark("datetime", delay)
    kept = clean.dropDuplicatesWithinWatermark(list(keys))
    return kept.withColumn(_KEPT, F.lit(True)).unionByName(clean.withColumn(_KEPT, F.lit(False)))


def _stored_shape(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema, T.StructField(BATCH, T.LongType())])


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """The lake or the late table; empty before the first row."""
    return read_lake(spark, path, schema=_stored_shape(T.StructType([*OBSERVATION, T.StructField(DAY, T.DateType())])))


def _write(df: DataFrame, path: str, batch_id: int) -> None:
    (
        df.withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        .hint("rebalance", DAY)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY, BATCH)
        .parquet(path)
    )


def _keys_before(spark: SparkSession, path: str, schema: T.StructType, batch_id: int, days: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that earlier batches stored on the given days; a scan of these days' key columns."""
    stored = read_lake(spark, path, schema=_stored_shape(schema)).filter(F.col(BATCH) < batch_id)
    listed = [r[0] for r in days.limit(MOST_DAYS + 1).collect()]
    if len(listed) <= MOST_DAYS:
        stored = stored.filter(F.col(DAY).isin(listed))
    return stored.select(*keys)


def write_with_late(batch: DataFrame, batch_id: int, lake: str, late: str, keys: Sequence[str] = KEYS) -> None:
    """Store one micro-batch of :func:`with_late_rows` in both tables.

    Duplicates of a key that is known, in this batch or before, are no late rows.
    Only rows that the deduplication held back are looked up, on their own days.
    """
    spark = batch.sparkSession
    batch = with_day(batch).persist()
    try:
        kept = batch.filter(_KEPT).drop(_KEPT)
        came = batch.filter(~F.col(_KEPT)).drop(_KEPT)
        _write(kept, lake, batch_id)
        held = came.join(kept.select(*keys), list(keys), "left_anti")
        days = held.select(DAY).distinct()
        for path in (lake, late):
            held = held.join(_keys_before(spark, path, kept.schema, batch_id, days, keys), list(keys), "left_anti")
        _write(dedupe(held, keys), late, batch_id)
    finally:
        batch.unpersist()


def start_late_aware_sink(
    messages: DataFrame,
    lake: str,
    late: str,
    checkpoint: str,
    delay: str,
    every: str | None = "30 seconds",
    keys: Sequence[str] = KEYS,
    name: str | None = None,
) -> StreamingQuery:
    """Clean a stream of messages into a lake and a table of rows later than ``delay``.

    The state holds the keys of the delay. Together the tables hold every key once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_with_late(batch, batch_id, lake, late, keys)

    writer = with_late_rows(messages, delay, keys).writeStream.outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint).foreachBatch(write)
    if name:
        writer = writer.queryName(name)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
