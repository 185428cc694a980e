"""Waiting for and stopping streaming queries."""

from __future__ import annotations

import logging
from collections.abc import Collection

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

log = logging.getLogger(__name__)


def stop_all(spark: SparkSession, names: Collection[str] | None = None) -> list[str]:
    """Stop every active query, or those of the given names; returns their names (or ids)."""
    stopped = []
    for query in spark.streams.active:
        if names is not None and query.name not in names:
            continue
        query.stop()
        stopped.append(query.name or query.id)
    return stopped


def wait_any(spark: SparkSession, timeout: int | None = None) -> None:
    """Block until one query ends; raises if it failed."""
    spark.streams.awaitAnyTermination(timeout)


class DroppedRows(StreamingQueryListener):
    """Logs how many rows came too late for a watermark."""

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        dropped = sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)
        if dropped:
            log.warning("%s: %d rows dropped by the watermark", event.progress.name or event.progress.id, dropped)

    def onQueryTerminated(self, event) -> None:
        pass


def log_dropped(spark: SparkSession) -> DroppedRows:
    listener = DroppedRows()
    spark.streams.addListener(listener)
    return listener


def drain(*queries: StreamingQuery) -> None:
    """Wait for queries that stop by themselves once the input is used up."""
    for query in queries:
        query.awaitTermination()
