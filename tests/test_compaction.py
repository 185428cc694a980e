"""Compacted days: same rows, fewer files, no reader between two states."""

import glob

import pytest
from pyspark.sql import functions as F

from conftest import rows
from stationflow.sources import compaction, readers, sinks, storage
from stationflow.sources.synthetic import synthetic_observations
from stationflow.streaming import control, etl


def run_stream(spark, feed, lake, checkpoint):
    stream = etl.clean_stream(readers.read_message_files(spark, feed, max_files_per_trigger=1))
    control.drain(etl.start_lake_sink(stream, lake, checkpoint, every=None))


@pytest.fixture
def lake(spark, tmp_path):
    """A lake of two days in many files, and a function that adds more."""
    path = str(tmp_path / "lake")

    def add(df):
        table = etl.normalize_observations(etl.clean_observations(df)).repartition(3)
        sinks.with_day(table).write.mode("append").partitionBy(sinks.DAY).parquet(path)

    add(synthetic_observations(spark, 96, ("A", "B")))
    return path, add


@pytest.fixture
def streamed(spark, tmp_path):
    """A streamed lake of two days in many files, and a function that streams more messages into it."""
    feed, path, checkpoint = str(tmp_path / "feed"), str(tmp_path / "lake"), str(tmp_path / "checkpoint")

    def add(df):
        sinks.publish_to_files(sinks.as_messages(df), feed)
        run_stream(spark, feed, path, checkpoint)

    add(synthetic_observations(spark, 96, ("A", "B")).repartition(2))
    return path, add, lambda: run_stream(spark, feed, path, checkpoint)


def opened(df):
    """Data files that a scan of ``df`` lists."""
    return len(df.inputFiles())


def test_fewer_files_same_rows_and_a_restart_adds_nothing(spark, streamed):
    path, add, restart = streamed
    plain = readers.read_lake(spark, path)
    want, before = rows(plain, "city", "datetime"), opened(plain)
    done = compaction.compact(spark, path)
    assert [e.version for e in done] == [0] * len(done) and sum(e.rows for e in done) == 96
    view = compaction.read_compacted(spark, path)
    assert view.columns == plain.columns and rows(view, "city", "datetime") == want
    written = glob.glob(f"{path}/_compacted/data/*/*/*.parquet")
    assert len(written) == len(done) < before
    assert rows(readers.read_lake(spark, path), "city", "datetime") == want  # the sink's own table is as it was
    restart()
    assert compaction.read_compacted(spark, path).count() == 96
    assert compaction.compact(spark, path) == []
    assert readers.load_observations(spark, path).count() == 96
    add(synthetic_observations(spark, 30, ("C",)).coalesce(1))
    assert compaction.read_compacted(spark, path).count() == 126
    assert compaction.compact(spark, path)
    assert rows(compaction.read_compacted(spark, path), "city", "datetime") == rows(readers.read_lake(spark, path), "city", "datetime")


def test_later_files_join_and_are_compacted_with_the_old_version(spark, lake):
    path, add = lake
    first = compaction.compact(spark, path)
    add(synthetic_observations(spark, 30, ("C",)).repartition(2))
    view = compaction.read_compacted(spark, path)
    assert view.count() == 126 and view.select("city", "datetime").distinct().count() == 126
    assert set(compaction.fragmented_days(spark, path)) <= {e.day for e in first}
    second = compaction.compact(spark, path)
    assert {e.version for e in second} == {1} and compaction.read_compacted(spark, path).count() == 126
    assert compaction.fragmented_days(spark, path) == []
    assert compaction.vacuum(spark, path) == []  # young ones stay
    gone = compaction.vacuum(spark, path, older_than_seconds=0)
    assert len(gone) == 2 * len(second)
    assert rows(compaction.read_compacted(spark, path), "city", "datetime") == rows(readers.read_lake(spark, path), "city", "datetime")


def test_a_reader_that_planned_before_sees_its_version(spark, lake):
    path, add = lake
    compaction.compact(spark, path)
    view = compaction.read_compacted(spark, path)
    add(synthetic_observations(spark, 30, ("C",)))
    compaction.compact(spark, path)
    assert view.count() == 96


def test_replaced_files_can_go(spark, lake):
    path, add = lake
    want = rows(compaction.read_compacted(spark, path), "city", "datetime")
    compaction.compact(spark, path)
    assert compaction.vacuum(spark, path, older_than_seconds=0, sources=True)
    assert glob.glob(f"{path}/obs_date=*/*.parquet") == []
    assert rows(compaction.read_compacted(spark, path), "city", "datetime") == want


def test_a_crash_before_publishing_changes_nothing(spark, lake, monkeypatch):
    path, add = lake
    want = rows(compaction.read_compacted(spark, path), "city", "datetime")
    with monkeypatch.context() as patch:
        patch.setattr(storage, "publish_text", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            compaction.compact(spark, path)
    assert compaction.entries(spark, path) == {}
    assert rows(compaction.read_compacted(spark, path), "city", "datetime") == want
    assert compaction.compact(spark, path)
    assert rows(compaction.read_compacted(spark, path), "city", "datetime") == want
    assert compaction.vacuum(spark, path, older_than_seconds=0)
    assert rows(compaction.read_compacted(spark, path), "city", "datetime") == want


def test_of_two_compactions_of_one_version_the_later_is_refused(spark, lake, monkeypatch):
    path, _ = lake
    day = compaction.fragmented_days(spark, path)[0]
    publish, raced = storage.publish_text, []

    def slower(spark_, name, text):
        if not raced:
            raced.append(day)
            compaction.compact(spark, path, [day])
        publish(spark_, name, text)

    monkeypatch.setattr(storage, "publish_text", slower)
    with pytest.raises(FileExistsError):
        compaction.compact(spark, path, [day])
    assert compaction.read_compacted(spark, path).count() == 96
    assert len(storage.names(spark, f"{path}/_compacted/entries")) == 1


def test_batch_lake_with_rows_without_time(spark, tmp_path):
    path = str(tmp_path / "lake")
    table = spark.createDataFrame([(None, "A", 1.0), ("2024-01-01 00:00:00", "A", 2.0), ("2024-01-02 00:00:00", None, None)], "t string, city string, temperature double")
    table = table.select(F.col("t").cast("timestamp").alias("datetime"), "city", "temperature")
    for _ in range(2):
        sinks.write_parquet(table, path, mode="append", by_day=True)
    want = rows(readers.read_lake(spark, path), "datetime", "city")
    assert {e.day for e in compaction.compact(spark, path)} == {"2024-01-01", "2024-01-02", compaction.NULL_DAY}
    assert rows(compaction.read_compacted(spark, path), "datetime", "city") == want
    sinks.write_parquet(table, path, mode="append", by_day=True)
    assert compaction.read_compacted(spark, path).count() == 9
    assert compaction.read_compacted(spark, path).filter("obs_date = '2024-01-01'").count() == 3


def test_new_columns_of_later_files(spark, tmp_path):
    path = str(tmp_path / "lake")
    old = spark.sql("SELECT timestamp'2024-01-01 00:00:00' AS datetime, 'A' AS city")
    for df in (old, old.withColumn("temperature", F.lit(1.0))):
        sinks.write_parquet(df, path, mode="append", by_day=True)
    assert compaction.compact(spark, path)[0].rows == 2
    view = compaction.read_compacted(spark, path, merge_schema=True)
    assert sorted(r["temperature"] or 0 for r in view.collect()) == [0, 1.0]


def test_day_filters_prune_every_part(spark, lake):
    path, add = lake
    days = compaction.fragmented_days(spark, path)
    compaction.compact(spark, path, days[:1])
    plan = compaction.read_compacted(spark, path).filter(F.col("obs_date") == days[0])._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("obs_date" in line.split("PartitionFilters:")[1].split("]")[0] for line in scans)


def test_missing_and_unfragmented_lakes(spark, tmp_path):
    assert compaction.compact(spark, str(tmp_path / "none")) == []
    assert compaction.read_compacted(spark, str(tmp_path / "none")).count() == 0
