"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.session import stage


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside are removed as it ends, not when the driver's garbage is collected."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "true")
        yield
    finally:
        spark.conf.set(key, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared folder and read back.

    Cuts lineage: a lost executor costs no recomputation of what lies before,
    and the shuffles of the writing are not needed any more.
    ``stationflow.session.drop_staged`` deletes these tables after a run.
    """
    with shuffles_removed(df.sparkSession):
        return stage(df, "llm", name)


def own_name() -> str:
    """A column name that no table has."""
    return f"own_{uuid.uuid4().hex}"


def texts(docs: DataFrame, *keys: str) -> DataFrame:
    """Only ``keys`` and the whole text, a null text as the empty one."""
    return docs.select(*[F.col(k) for k in keys], F.coalesce(F.col("text"), F.lit("")).alias("text"))


def held_out(doc_id: Column | str) -> Column:
    """Rows whose labels no model may see: a fifth, by the checksum of the id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """``label, text`` of at most ``bound`` labelled ids that are not held out.

    Ids with the smallest hash are taken, so the choice does not follow the
    order of the table. The ids are few enough to be sent to every executor.
    """
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
        .select("doc_id", F.col(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(bound)
    )
    return texts(docs, "doc_id").join(F.broadcast(chosen), "doc_id").select("label", "text")


def rows_of(batches: Iterable[pa.RecordBatch], size: int = 256) -> Iterator[tuple]:
    """Rows of Arrow batches, a few at a time as Python objects."""
    for batch in batches:
        for begin in range(0, batch.num_rows, size):
            part = batch.slice(begin, size)
            yield from zip(*(column.to_pylist() for column in part.columns), strict=True)


def batched(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``size`` rows from tuples."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
