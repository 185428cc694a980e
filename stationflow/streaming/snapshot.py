"""Newest reading per station as versioned snapshots, a pointer switched last.

Batch ``n`` is merged with the snapshot of its predecessor into a folder of its
own, and only when that is complete a pointer of that number appears, in one step.
Readers follow the newest pointer, so they see the state before a batch or after
it. A batch that runs again is skipped if its pointer is there, and otherwise
writes its folder anew from the same predecessor: a crash at any moment changes
nothing. Write times come from the stream's batch, which are the same on a replay.

    <path>/snapshots/batch=<n>/…     one row per live station
    <path>/pointers/<n>              appears when the snapshot is complete

Unlike the deltas of :mod:`.state`, a reader opens one snapshot instead of all
batches of the lifetime, and every batch rewrites one row per live station:
for states read more often than written.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import StateConfig
from ..operators.combine import latest_per_city
from ..schema import CURRENT_STATE, OBSERVATION
from ..sources import storage
from .state import as_state, session_now

WRITTEN = "written_at"
#: Digits of a pointer's name, so that names sort like numbers.
_DIGITS = 20


def _snapshot(path: str, batch_id: int) -> str:
    return f"{path}/snapshots/batch={batch_id}"


def pointers(spark: SparkSession, path: str) -> list[int]:
    """Batches whose snapshot is complete, oldest first."""
    return [int(n) for n in storage.names(spark, f"{path}/pointers")]


def _read(spark: SparkSession, path: str, batch_id: int | None) -> DataFrame:
    if batch_id is None:
        return spark.createDataFrame([], CURRENT_STATE)
    return spark.read.schema(CURRENT_STATE).parquet(_snapshot(path, batch_id))


def _whole(rows: DataFrame) -> DataFrame:
    """Rows in the shape of the table; measures that a batch lacks are null."""
    has = rows.schema["reading"].dataType.names
    fields = [(F.col(f"reading.{f.name}") if f.name in has else F.lit(None)).cast(f.dataType).alias(f.name) for f in OBSERVATION]
    return rows.withColumn("reading", F.struct(*fields)).select(*CURRENT_STATE.names)


def _live(df: DataFrame, now, config: StateConfig) -> DataFrame:
    """Rows younger than the lifetime at ``now`` (a column or local time)."""
    moment = now if not isinstance(now, datetime) else F.lit(now.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")
    return df.filter(F.col(WRITTEN) > moment - F.make_dt_interval(secs=F.lit(float(config.ttl_seconds))))


def merged(before: DataFrame, batch: DataFrame) -> DataFrame:
    """One row per key: the newest reading, of equal ones the one written last."""
    both = before.unionByName(batch)
    newest = F.max_by(F.struct(*[c for c in both.columns if c != "key"]), F.struct("reading", WRITTEN))
    return both.groupBy("key").agg(newest.alias("r")).select("key", "r.*")


def write_snapshot_batch(
    batch: DataFrame, batch_id: int, path: str, config: StateConfig = StateConfig(), keep: int = 3
) -> bool:
    """Merge one micro-batch into the state; ``False`` if it is in there already or empty.

    ``batch`` may carry ``written_at``, else the present is taken. Entries that have expired at
    the batch's last write time are left out. The ``keep`` newest snapshots stay for
    readers that have begun; older ones, and pointers to them, are removed.
    """
    spark = batch.sparkSession
    if WRITTEN not in batch.columns:
        batch = batch.withColumn(WRITTEN, F.current_timestamp())
    # One row per station; the batch itself runs once.
    new = latest_per_city(batch).persist()
    try:
        moment = new.agg(F.max(WRITTEN)).first()[0]
        # Also a batch that is not needed has run by now: the stream's own state depends on it.
        done = pointers(spark, path)
        if moment is None or (done and done[-1] >= batch_id):
            return False
        rows = _whole(as_state(new.drop(WRITTEN), written_at=F.lit(moment), config=config))
        before = _live(_read(spark, path, done[-1] if done else None), F.lit(moment), config)
        merged(before, rows).hint("rebalance").write.mode("overwrite").parquet(_snapshot(path, batch_id))
    finally:
        new.unpersist()
    storage.publish_text(spark, f"{path}/pointers/{batch_id:0{_DIGITS}d}", "")
    for old in done[: max(len(done) + 1 - keep, 0)]:
        storage.delete(spark, f"{path}/pointers/{old:0{_DIGITS}d}")
        storage.delete(spark, _snapshot(path, old))
    return True


def read_snapshot(
    spark: SparkSession, path: str, now: datetime | None = None, config: StateConfig = StateConfig()
) -> DataFrame:
    """The current-reading table of the newest complete snapshot; entries expired at ``now`` are left out."""
    done = pointers(spark, path)
    return _live(_read(spark, path, done[-1] if done else None), now or session_now(spark), config)


def start_snapshot_sink(
    df: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = "5 seconds",
    config: StateConfig = StateConfig(),
    name: str | None = None,
) -> StreamingQuery:
    """Keep the newest reading per station as snapshots; safe to replay."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_snapshot_batch(batch, batch_id, path, config)

    # In a stream this is the time of the batch, from its log: a replay gets the same.
    stamped = df.withColumn(WRITTEN, F.current_timestamp())
    writer = stamped.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    if name:
        writer = writer.queryName(name)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
