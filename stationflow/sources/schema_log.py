"""The schema of an evolving lake, written with the data.

A writer whose columns the log does not have yet adds a version before it
writes: the union of all columns so far. Readers declare the newest version, so
neither they nor the planner open file footers; files without a column give
nulls. A version appears in one step and its number is never taken twice, so of
two writers with new columns one starts again from the other's version.

    <lake>/_schemas/<n>    columns of version n, as JSON
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from . import storage
from .sinks import DAY, rebalanced, with_day

_DIGITS = 9
#: Kinds that Parquet readers widen, each to those after it.
_WIDER = ([T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()], [T.FloatType(), T.DoubleType()])
_ATTEMPTS = 20


def schema_versions(spark: SparkSession, path: str) -> list[T.StructType]:
    """All logged versions, oldest first."""
    folder = f"{path}/_schemas"
    return [T.StructType.fromJson(json.loads(storage.read_text(spark, f"{folder}/{n}"))) for n in storage.names(spark, folder)]


def logged_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The newest version; null for a lake without a log."""
    names = storage.names(spark, f"{path}/_schemas")
    return T.StructType.fromJson(json.loads(storage.read_text(spark, f"{path}/_schemas/{names[-1]}"))) if names else None


def _common(name: str, a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b:
        return a
    for kinds in _WIDER:
        if a in kinds and b in kinds:
            return max(a, b, key=kinds.index)
    raise ValueError(f"column {name} is {a.simpleString()} in the lake and {b.simpleString()} in new rows")


def united(a: T.StructType, b: T.StructType) -> T.StructType:
    """Columns of both, in the order they came, all of them nullable; numbers take the wider kind."""
    fields = {f.name: f.dataType for f in a}
    for f in b:
        fields[f.name] = _common(f.name, fields[f.name], f.dataType) if f.name in fields else f.dataType
    return T.StructType([T.StructField(n, k) for n, k in fields.items()])


def record_schema(spark: SparkSession, path: str, schema: T.StructType) -> T.StructType:
    """Make sure that the log has the columns of ``schema``; returns its newest version."""
    for _ in range(_ATTEMPTS):
        known = logged_schema(spark, path)
        wanted = united(known or T.StructType(), schema)
        if wanted == known:
            return wanted
        n = len(storage.names(spark, f"{path}/_schemas"))
        try:
            storage.publish_text(spark, f"{path}/_schemas/{n:0{_DIGITS}d}", wanted.json())
            return wanted
        except FileExistsError:  # another writer was first: unite with its version
            continue
    raise RuntimeError(f"schema log of {path} changes all the time")


def append_evolving(df: DataFrame, path: str, by_day: bool = True) -> None:
    """Append rows, with whatever columns they have, after their schema is in the log."""
    table = with_day(df) if by_day and "datetime" in df.columns else df
    record_schema(df.sparkSession, path, table.schema)
    if DAY in table.columns:
        rebalanced(table).write.mode("append").partitionBy(DAY).parquet(path)
    else:
        table.write.mode("append").parquet(path)
