"""Exports in a verified order, and lakes with a schema log."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from stationflow.sources import readers, schema_log, sinks, storage
from stationflow.sources import sorted as sorted_export

ORDER = ["datetime", "city"]


@pytest.fixture
def table(spark):
    made = spark.range(1000, numPartitions=7).select(
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 7919 % 500 * 60).alias("datetime"), F.concat(F.lit("s"), F.col("id") % 2).alias("city"), "id"
    )
    return made.union(spark.sql("SELECT timestamp(NULL), 's0', 1000L UNION ALL SELECT timestamp(NULL), NULL, 1001L"))


def key(r):
    return ((r[0] is not None, r[0] or 0), (r[1] is not None, r[1] or ""))


@pytest.mark.parametrize("most_rows", [0, 37])
def test_positions_follow_the_order(spark, tmp_path, table, most_rows):
    setting = "spark.sql.files.maxRecordsPerFile"
    before = spark.conf.get(setting)
    spark.conf.set(setting, most_rows)
    try:
        with_ranges(spark, lambda: sorted_export.write_sorted(table, str(tmp_path / "x"), ORDER))
    finally:
        spark.conf.set(setting, before)
    got = rows(sorted_export.read_sorted(spark, str(tmp_path / "x")).select(*ORDER, "id", sorted_export.POSITION), sorted_export.POSITION)
    assert [r[3] for r in got] == list(range(1002))
    keys = [key(r) for r in got]
    assert keys == sorted(keys) and {r[2] for r in got} == set(range(1002))
    files = sorted_export.manifest(spark, str(tmp_path / "x"))
    assert files.count() > 1 and files.agg(F.sum("n")).first()[0] == 1002
    assert sorted_export.disorder(spark, str(tmp_path / "x")).isEmpty()


def with_ranges(spark, run):
    """Runs with ranges that are not merged for being small."""
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        run()
    finally:
        spark.conf.set(setting, "true")


def test_a_range_opens_only_files_that_meet_it(spark, tmp_path, table):
    path = str(tmp_path / "x")
    with_ranges(spark, lambda: sorted_export.write_sorted(table, path, ORDER))
    low, high = (F.timestamp_seconds(F.lit(1_700_000_000 + 60 * m)) for m in (10, 20))
    part = sorted_export.read_range(spark, path, low, high)
    assert part.count() == 22 and len(part.inputFiles()) < sorted_export.manifest(spark, path).count() + 1
    whole = sorted_export.read_sorted(spark, path).filter(F.col("datetime").between(low, high))
    assert rows(part, "id") == rows(whole, "id")
    assert sorted_export.read_range(spark, path, F.timestamp_seconds(F.lit(1)), F.timestamp_seconds(F.lit(2))).count() == 0


def test_disorder_is_found(spark, tmp_path, table):
    path = str(tmp_path / "x")
    sorted_export.write_sorted(table, path, ORDER)
    table.limit(3).coalesce(1).write.mode("append").parquet(path)
    assert sorted_export.disorder(spark, path).count() == 3


def test_an_unfinished_export_is_refused(spark, tmp_path, table):
    table.write.parquet(str(tmp_path / "x"))
    with pytest.raises(FileNotFoundError):
        sorted_export.read_sorted(spark, str(tmp_path / "x"))


def test_nothing_to_sort(spark, tmp_path, table):
    sorted_export.write_sorted(table.limit(0), str(tmp_path / "x"), ORDER)
    assert sorted_export.read_sorted(spark, str(tmp_path / "x")).count() == 0


# -- schema log --------------------------------------------------------------


def struct(**kinds):
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()])


def test_columns_join_and_numbers_widen():
    a, b = struct(x=T.IntegerType(), y=T.StringType()), struct(z=T.DoubleType(), x=T.LongType())
    assert schema_log.united(a, b) == struct(x=T.LongType(), y=T.StringType(), z=T.DoubleType())
    with pytest.raises(ValueError, match="column y"):
        schema_log.united(a, struct(y=T.DoubleType()))


def test_evolved_lake_is_read_without_footers(spark, tmp_path):
    path = str(tmp_path / "lake")
    base = spark.sql("SELECT timestamp'2024-01-01 05:00:00' AS datetime, 'A' AS city")
    schema_log.append_evolving(base, path)
    schema_log.append_evolving(base.withColumn("temperature", F.lit(1.5)), path)
    schema_log.append_evolving(base.drop("city").withColumn("n", F.lit(1)), path)
    schema_log.append_evolving(base.withColumn("n", F.lit(5_000_000_000)), path)
    assert len(schema_log.schema_versions(spark, path)) == 4
    group = "reading the evolved lake"
    spark.sparkContext.setJobGroup(group, group)
    try:
        table = readers.load_observations(spark, path)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == []  # footers would be read by a job
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    got = [tuple(r) for r in table.select("city", "temperature", "n").collect()]
    assert sorted(map(str, got)) == sorted(map(str, [("A", None, None), ("A", 1.5, None), (None, None, 1), ("A", None, 5_000_000_000)]))


def test_a_wrong_type_is_refused_before_anything_is_written(spark, tmp_path):
    path = str(tmp_path / "lake")
    schema_log.append_evolving(spark.sql("SELECT 'A' AS city, 1.5D AS temperature"), path)
    with pytest.raises(ValueError, match="temperature"):
        schema_log.append_evolving(spark.sql("SELECT 'A' AS city, 'warm' AS temperature"), path)
    assert readers.load_observations(spark, path).count() == 1


def test_two_writers_with_new_columns(spark, tmp_path, monkeypatch):
    path, publish, raced = str(tmp_path / "lake"), storage.publish_text, []

    def second(*args):
        if not raced:
            raced.append(True)
            schema_log.record_schema(spark, path, struct(b=T.StringType()))
        publish(*args)

    monkeypatch.setattr(storage, "publish_text", second)
    got = schema_log.record_schema(spark, path, struct(a=T.StringType()))
    assert set(got.names) == {"a", "b"} and schema_log.logged_schema(spark, path) == got


def test_a_lake_without_log_is_merged_as_before(spark, tmp_path):
    path = str(tmp_path / "lake")
    assert schema_log.logged_schema(spark, path) is None
    for df in (spark.sql("SELECT 'A' AS city"), spark.sql("SELECT 'B' AS city, 1 AS n")):
        sinks.write_parquet(df, path, mode="append")
    assert readers.load_observations(spark, path).columns == ["city", "n"]
