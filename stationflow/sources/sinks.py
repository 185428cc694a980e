"""Lake, message, database and model sinks."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.clean import dedupe
from ..operators.combine import upsert
from ..schema import PREDICTION, jdbc_column_types
from ..session import stage

log = logging.getLogger(__name__)

DAY = "obs_date"


def lake_path(root: str, layer: str, dataset: str) -> str:
    """``root/layer/dataset``."""
    return "/".join([root.rstrip("/"), layer, dataset])


def with_day(df: DataFrame) -> DataFrame:
    return df.withColumn(DAY, F.to_date("datetime"))


def rebalanced(df: DataFrame) -> DataFrame:
    """Rows of a day together, large days split and small ones merged at run time.

    Keeps a partitioned write from leaving one file per task and day.
    """
    return df.hint("rebalance", DAY)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", by_day: bool = False) -> None:
    """Batch Parquet write, optionally one folder per day so date filters prune."""
    if by_day:
        rebalanced(with_day(df)).write.mode(mode).partitionBy(DAY).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


def write_lake(df: DataFrame, path: str, checkpoint: str | None = None, **stream_options):
    """Store a batch table, or start the streaming query that stores a stream."""
    if df.isStreaming:
        from ..streaming.etl import start_lake_sink

        return start_lake_sink(df, path, checkpoint, **stream_options)
    write_parquet(df, path, by_day="datetime" in df.columns)
    return None


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header; blanks around text are part of the text."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def as_messages(
    df: DataFrame,
    restamp: str | None = None,
    offset: str = "INTERVAL 0 SECONDS",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rows -> keyed JSON messages, nulls spelled out, unparseable numbers null.

    ``restamp``: ``None`` keeps the time, ``"now"`` takes the send time,
    ``"offset"`` moves it by an interval literal.
    """
    pattern = "yyyy-MM-dd HH:mm:ss"
    if restamp == "now":
        stamp = F.date_format(F.current_timestamp(), pattern)
    elif restamp == "offset":
        stamp = F.date_format(F.try_to_timestamp("datetime") + F.expr(offset), pattern)
    elif restamp is None:
        stamp = F.col("datetime")
    else:
        raise ValueError(f"unknown restamp mode: {restamp}")

    def number(name: str):
        return F.col(name).try_cast("double").alias(name)

    body = F.struct(
        stamp.alias("datetime"),
        F.col("City"),
        number("temperature"),
        number("humidity"),
        number("pressure"),
        F.col("weather_desc"),
        number("wind_direction"),
        number("wind_speed"),
    )
    value = F.to_json(body, {"ignoreNullFields": "false"})
    return df.select(*keep, F.col("City").alias("key"), value.alias("value"))


def publish(messages: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Send messages to Kafka; needs the Kafka connector on the class path."""
    writer = messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
    writer.options(**options).save()


def publish_to_files(messages: DataFrame, path: str) -> None:
    """Message bodies as lines of text files, the offline stand-in for a topic."""
    messages.select("value").write.mode("append").text(path)


def jdbc_writer(
    df: DataFrame, mode: str = "append", batch_size: int = 1000, connections: int = 16
):
    """Writer with batched inserts and a bound on open connections.

    Overwrite empties the table instead of recreating it, so keys and grants stay.
    """
    writer = (
        df.write.mode(mode)
        .option("batchsize", batch_size)
        .option("numPartitions", connections)
        .option("createTableColumnTypes", jdbc_column_types(df.schema))
    )
    return writer.option("truncate", True) if mode == "overwrite" else writer


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    mode: str = "append",
    on_error: str = "raise",
    **options: int,
) -> bool:
    """Write predictions to a database table.

    ``on_error="report"`` turns a failure into ``False``, after logging it.
    """
    try:
        jdbc_writer(df, mode, **options).jdbc(url, table, properties=dict(properties))
    except Exception:
        if on_error == "raise":
            raise
        log.exception("writing %s failed", table)
        return False
    return True


def as_predictions(df: DataFrame) -> DataFrame:
    """The canonical prediction row; absent columns are null, ``created_at`` is now."""
    columns = []
    for f in PREDICTION:
        if f.name == "created_at":
            columns.append(F.current_timestamp().alias("created_at"))
        elif f.name in df.columns:
            columns.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*columns)


#: Changed days that an upsert names in its scan.
MOST_DAYS = 3_660


def upsert_predictions(
    new: DataFrame, path: str, keys: Sequence[str] = ("city", "datetime")
) -> None:
    """Replace or add predictions by key, rewriting only the days that change.

    The new rows are staged once, because the merge reads them three times. Up
    to ``MOST_DAYS`` changed days become a partition filter, so other days are
    neither listed nor read; more are matched by a join. Rows without time
    have a day folder of their own and are kept as they are. Folders are moved in
    one by one once all are written: a failure before leaves the table as it was.
    """
    from .readers import read_lake

    spark = new.sparkSession
    fresh = stage(with_day(dedupe(as_predictions(new), keys)), "predictions")
    shape = fresh.schema
    old = read_lake(spark, path, schema=shape)
    days = fresh.select(DAY).distinct()
    listed = [r[0] for r in days.limit(MOST_DAYS + 1).collect()]
    if len(listed) <= MOST_DAYS:
        touched = old.filter(F.col(DAY).isin([d for d in listed if d is not None]) | (F.col(DAY).isNull() & F.lit(None in listed)))
    else:
        touched = old.join(days.withColumnRenamed(DAY, "_day"), F.col(DAY).eqNullSafe(F.col("_day")), "left_semi")
    merged = upsert(touched, fresh, keys)
    writer = rebalanced(merged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(DAY).parquet(path)


def save_models(models: Mapping[str, PipelineModel], base: str) -> dict[str, str]:
    """One folder per target below ``base``, replacing earlier versions."""
    paths = {}
    for target, model in models.items():
        paths[target] = f"{base.rstrip('/')}/{target}_model"
        model.write().overwrite().save(paths[target])
    return paths


def load_models(base: str, targets: Sequence[str]) -> dict[str, PipelineModel]:
    return {t: PipelineModel.load(f"{base.rstrip('/')}/{t}_model") for t in targets}
