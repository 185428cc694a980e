"""Session construction and the few questions asked of a session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_local_root: str | None = None
#: Tables that :func:`stage` has written, until :func:`drop_staged`.
_staged: list[str] = []


def build_session(app: str = "stationflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC calendar functions.

    Sizing (executors, shuffle partitions, memory) is left to the cluster;
    keyword arguments use ``__`` for dots, e.g. ``spark__sql__shuffle__partitions``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.parquet.filterPushdown", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh path below the folder every executor can reach.

    The folder is the one named by ``spark.checkpoint.dir``. Only a local
    session without that setting gets a temporary folder.
    """
    global _local_root
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
        _local_root = _local_root or tempfile.mkdtemp(prefix="stationflow-")
        root = _local_root
    return "/".join([root.rstrip("/"), *parts, uuid.uuid4().hex])


def stage(df: DataFrame, *parts: str) -> DataFrame:
    """Write ``df`` once below the shared folder and continue from the table.

    Cuts lineage in a way that survives executor loss, and lets every later
    reader prune columns and row groups.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "staged", *parts)
    _staged.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> int:
    """Delete the tables staged so far; frames that read them can no longer run."""
    n = len(_staged)
    while _staged:
        path = spark._jvm.org.apache.hadoop.fs.Path(_staged.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return n
