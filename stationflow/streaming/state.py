"""Newest reading per station with a lifetime, as a table of small deltas.

A micro-batch only writes the newest reading of the stations it contains, into
a folder of its own. Entries live ``ttl_seconds``, so a reader needs just the
deltas of that span and takes the newest reading among them. Nothing is
rewritten, nothing passes the driver, and a replayed batch replaces its own
folder.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import StateConfig
from ..operators.combine import latest_per_city
from ..operators.serving import reading_json, state_key
from ..schema import CURRENT_STATE, OBSERVATION

BATCH = "batch_id"
HOUR = "written_hour"
HOUR_FORMAT = "%Y-%m-%d-%H"
STORED = T.StructType(
    [*CURRENT_STATE, T.StructField(HOUR, T.StringType()), T.StructField(BATCH, T.LongType())]
)


def as_state(df: DataFrame, written_at: Column | None = None, config: StateConfig = StateConfig()) -> DataFrame:
    """Newest reading per station as ``key, city, reading, value, written_at``."""
    columns = [f.name for f in OBSERVATION if f.name in df.columns]
    newest = latest_per_city(df.select(*columns))
    return newest.select(
        state_key(F.col("city"), config.prefix).alias("key"),
        "city",
        F.struct(*columns).alias("reading"),
        reading_json(columns).alias("value"),
        (F.current_timestamp() if written_at is None else written_at).alias("written_at"),
    )


def write_state_batch(
    batch: DataFrame, batch_id: int, path: str, config: StateConfig = StateConfig()
) -> None:
    """Store one micro-batch's delta; an empty batch writes nothing.

    The delta has one row per station; the rebalance hint sizes its files by
    what it holds and leaves the aggregation its parallelism. Hours whose
    entries have all expired are removed.
    """
    if batch.isEmpty():
        return
    drop_expired(batch.sparkSession, path, config=config)
    (
        as_state(batch, config=config)
        .withColumn(HOUR, F.date_format("written_at", "yyyy-MM-dd-HH"))
        .withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        .hint("rebalance")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(HOUR, BATCH)
        .parquet(path)
    )


def read_state(
    spark: SparkSession,
    path: str,
    now: datetime | None = None,
    config: StateConfig = StateConfig(),
) -> DataFrame:
    """The current-reading table: live deltas merged to one row per station.

    Only the folders of hours that can hold live entries are given to the
    scan, so older ones are never listed; ``now`` is a local time and defaults to the present.
    """
    oldest = (now or session_now(spark)) - timedelta(seconds=config.ttl_seconds)
    paths = [f"{path}/{h}" for h in _hours(spark, path) if h.split("=", 1)[1] >= oldest.strftime(HOUR_FORMAT)]
    if not paths:
        deltas = spark.createDataFrame([], STORED)
    else:
        deltas = spark.read.schema(STORED).option("basePath", path).parquet(*paths)
    live = deltas.filter(F.col("written_at") > F.lit(oldest.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp"))
    newest = F.max_by(F.struct("city", "reading", "value", "written_at"), F.struct("reading", "written_at"))
    return live.groupBy("key").agg(newest.alias("r")).select("key", "r.*")


def session_now(spark: SparkSession) -> datetime:
    """The present in the session's time zone, without zone."""
    text = spark.sql("SELECT date_format(current_timestamp(), 'yyyy-MM-dd HH:mm:ss.SSSSSS')").first()[0]
    return datetime.strptime(text, "%Y-%m-%d %H:%M:%S.%f")


def _hours(spark: SparkSession, path: str) -> list[str]:
    """Hour folders; with expired ones removed, as many as the lifetime has hours."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    names = [s.getPath().getName() for s in files.listStatus(root) if s.isDirectory()]
    return sorted(n for n in names if n.startswith(f"{HOUR}="))


def expired_hours(
    spark: SparkSession, path: str, now: datetime | None = None, config: StateConfig = StateConfig()
) -> list[str]:
    """Names of hour folders that hold only expired entries and can be removed."""
    oldest = ((now or session_now(spark)) - timedelta(seconds=config.ttl_seconds)).strftime(HOUR_FORMAT)
    return [n for n in _hours(spark, path) if n.split("=", 1)[1] < oldest]


def drop_expired(
    spark: SparkSession, path: str, now: datetime | None = None, config: StateConfig = StateConfig()
) -> list[str]:
    """Remove the folders of :func:`expired_hours` and name them."""
    gone = expired_hours(spark, path, now, config)
    for name in gone:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return gone
