"""Batch and streaming scans of observations and predictions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import OBSERVATION, PREDICTION, RAW_OBSERVATION


def kafka_options(servers: str, topic: str, max_per_trigger: int | None = None, **extra: str) -> dict[str, str]:
    """One topic from its earliest offset, tolerating expired data."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options | extra


def read_messages(
    spark: SparkSession, options: Mapping[str, str], streaming: bool = True
) -> DataFrame:
    """Kafka records; needs the Kafka connector on the class path."""
    if streaming:
        return spark.readStream.format("kafka").options(**options).load()
    bounded = {k: v for k, v in options.items() if k != "maxOffsetsPerTrigger"}
    return spark.read.format("kafka").options(**bounded).load()


def read_message_files(
    spark: SparkSession, path: str, streaming: bool = True, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Messages stored one JSON text per line, with the ``value`` column Kafka has."""
    if not streaming:
        return spark.read.text(path)
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)


def decode_messages(messages: DataFrame, schema: T.StructType = RAW_OBSERVATION) -> DataFrame:
    """JSON in ``value`` -> columns; broken text or a wrong type becomes null."""
    parsed = F.from_json(F.col("value").cast("string"), schema)
    return messages.select(parsed.alias("data")).select("data.*")


def read_file(
    spark: SparkSession, path: str, schema: T.StructType = RAW_OBSERVATION, streaming: bool = False
) -> DataFrame:
    """CSV with header, JSON lines or Parquet by suffix, with a declared schema."""
    reader = (spark.readStream if streaming else spark.read).schema(schema)
    if path.endswith(".csv"):
        return reader.option("header", True).csv(path)
    if path.endswith(".json"):
        return reader.json(path)
    return reader.parquet(path)


def read_observations(spark: SparkSession, source: str, mode: str = "batch", **options) -> DataFrame:
    """Raw observations from ``kafka``, ``messages`` (files), ``file`` or ``synthetic``."""
    streaming = mode == "streaming"
    if source == "kafka":
        return decode_messages(read_messages(spark, kafka_options(**options), streaming))
    if source == "messages":
        return decode_messages(read_message_files(spark, streaming=streaming, **options))
    if source == "file":
        return read_file(spark, streaming=streaming, **options)
    if source == "synthetic":
        from .synthetic import synthetic_observations

        return synthetic_observations(spark, **options)
    raise ValueError(f"unknown source: {source}")


def read_lake(
    spark: SparkSession, path: str, schema: T.StructType | None = None, merge_schema: bool = False
) -> DataFrame:
    """Stored observations; a lake not written yet is an empty table of the same shape.

    With a declared ``schema`` no footer is read; ``merge_schema`` reads all.
    """
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path):
        return spark.createDataFrame([], schema or OBSERVATION)
    reader = spark.read.option("mergeSchema", merge_schema)
    return (reader.schema(schema) if schema else reader).parquet(path)


def load_observations(
    spark: SparkSession,
    path: str,
    city: str | None = None,
    limit: int | None = None,
    merge_schema: bool = True,
) -> DataFrame:
    """Lake scan with the station filter at the scan and an optional earliest-rows limit.

    Columns that only some files have are kept, as nulls elsewhere, unless ``merge_schema`` is off: by
    the lake's schema log if it has one, else by the footers of all files.
    Compacted days are read in place of the files they stand for.
    """
    from ..functions.text import to_timestamp
    from ..operators.clean import for_city
    from ..operators.combine import earliest_rows
    from .compaction import read_compacted
    from .schema_log import logged_schema

    df = read_compacted(spark, path, logged_schema(spark, path) if merge_schema else None, merge_schema)
    if "datetime" in df.columns and isinstance(df.schema["datetime"].dataType, T.StringType):
        df = df.withColumn("datetime", to_timestamp("datetime", T.StringType()))
    return earliest_rows(for_city(df, city), limit)


def read_wide_csv(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """Wide per-measure CSV tables as text columns; missing files are left out."""
    tables = {}
    for measure, path in paths.items():
        hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        if hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path):
            tables[measure] = spark.read.option("header", True).csv(path)
    return tables


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """The canonical prediction columns, whatever the table is partitioned by."""
    return spark.read.schema(PREDICTION).parquet(path).select(*PREDICTION.names)


def read_predictions_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    lower: str | None = None,
    upper: str | None = None,
    partitions: int = 1,
) -> DataFrame:
    """Prediction table over JDBC; time bounds split the scan into parallel ranges."""
    if partitions > 1 and lower and upper:
        return spark.read.jdbc(
            url, table, column="datetime", lowerBound=lower, upperBound=upper,
            numPartitions=partitions, properties=dict(properties),
        )
    return spark.read.jdbc(url, table, properties=dict(properties))
