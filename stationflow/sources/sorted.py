"""Exports whose order can be relied on.

Spark promises no order of rows read from files. Here the rows are range-partitioned
and sorted, every range is a file, and a manifest written last says which rows
each file holds: how many, its place among the files, and its first and last key. A
row's position in the export is its file's start plus its place in the file; a range
of keys is read from the files whose bounds meet it.

    <export>/part-…                    the rows
    <export>/_manifest/…               file, n, start, first, last
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import storage

POSITION = "_position"
FILE, PLACE = "_file", "_place"


def write_sorted(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """Export ``df`` in ascending ``order``, nulls first, as sorted files of disjoint ranges."""
    spark = df.sparkSession
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(path)
    key = F.struct(*order)
    files = _placed(spark, path).groupBy(FILE).agg(F.count("*").alias("n"), F.min(key).alias("first"), F.max(key).alias("last"))
    # One row per file. Names carry the number of the range, and of the file if a range was split.
    number = F.regexp_extract(FILE, r"^part-(\d+)", 1).cast("long")
    before = Window.orderBy(number, FILE).rowsBetween(Window.unboundedPreceding, -1)
    manifest = files.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    manifest.select(FILE, "n", "start", "first", "last").coalesce(1).write.parquet(f"{path}/_manifest")


def _placed(spark: SparkSession, path: str, files: Sequence[str] | None = None) -> DataFrame:
    rows = spark.read.parquet(*(f"{path}/{f}" for f in files)) if files else spark.read.parquet(path)
    return rows.select("*", F.col("_metadata.file_name").alias(FILE), F.col("_metadata.row_index").alias(PLACE))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """``_file, n, start, first, last`` of every file; an export that was not finished has none."""
    if not storage.exists(spark, f"{path}/_manifest/_SUCCESS"):
        raise FileNotFoundError(f"{path} has no complete manifest")
    return spark.read.parquet(f"{path}/_manifest")


def read_sorted(spark: SparkSession, path: str, files: Sequence[str] | None = None) -> DataFrame:
    """The export's rows with ``_position``, from 0; one row per file is sent to every executor for it."""
    starts = F.broadcast(manifest(spark, path).select(FILE, "start"))
    placed = _placed(spark, path, files).join(starts, FILE)
    return placed.withColumn(POSITION, F.col("start") + F.col(PLACE)).drop(FILE, PLACE, "start")


def read_range(spark: SparkSession, path: str, low: Column, high: Column) -> DataFrame:
    """Rows, with ``_position``, whose leading key is from ``low`` to ``high``, out of the files whose bounds meet that."""
    bounds = manifest(spark, path)
    leading = bounds.schema["first"].dataType.names[0]
    meets = (F.col(f"first.{leading}") <= high) | F.col(f"first.{leading}").isNull()
    names = [r[0] for r in bounds.filter(meets & (F.col(f"last.{leading}") >= low)).select(FILE).collect()]
    rows = read_sorted(spark, path, names or None)
    return rows.filter(F.col(leading).between(low, high)) if names else rows.limit(0)


def disorder(spark: SparkSession, path: str) -> DataFrame:
    """``_file, _place`` of rows out of order: before their predecessor, outside their file's bounds, before the end of
    the file that precedes it, or in a file that the manifest does not know.

    Empty for an export in order. A window per file: no task holds more than one.
    """
    bounds = manifest(spark, path)
    order = bounds.schema["first"].dataType.names
    key = F.struct(*order)
    end = F.lag("last").over(Window.orderBy("start"))
    known = F.broadcast(bounds.withColumn("end", end).select(FILE, "first", "last", "end"))
    placed = _placed(spark, path).withColumn("key", key)
    before = F.lag("key").over(Window.partitionBy(FILE).orderBy(PLACE))
    wrong = (F.col("key") < F.col("before")) | (F.col("key") < F.col("first")) | (F.col("key") > F.col("last")) | (F.col("key") < F.col("end"))
    return placed.withColumn("before", before).join(known, FILE, "left").filter(F.col("first").isNull() | F.coalesce(wrong, F.lit(False))).select(FILE, PLACE)
