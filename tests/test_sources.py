import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from stationflow.operators.clean import clean_observations
from stationflow.operators.normalize import normalize_observations
from stationflow.schema import OBSERVATION, PREDICTION, RAW_OBSERVATION, jdbc_column_types
from stationflow.sources import readers, sinks
from stationflow.sources.synthetic import synthetic_observations

GOOD = {
    "datetime": "2024-01-01 12:00:00", "City": "A", "temperature": 1.5, "humidity": 2.0, "pressure": 1000.0,
    "weather_desc": "rain", "wind_direction": 3.0, "wind_speed": 4.0,
}


def test_decode(spark):
    texts = [
        json.dumps(GOOD),
        "{bad",
        json.dumps(GOOD | {"temperature": "1.5"}),
        json.dumps({("city" if k == "City" else k): v for k, v in GOOD.items()}),
        json.dumps(GOOD | {"extra": 1}),
    ]
    df = spark.createDataFrame([(t.encode(),) for t in texts], "value binary")
    out = [r.asDict() for r in readers.decode_messages(df).collect()]
    assert out[0] == GOOD == out[4]
    assert set(out[1].values()) == {None}
    assert out[2] == GOOD | {"temperature": None}
    assert out[3] == GOOD | {"City": None}


@pytest.mark.parametrize("suffix", [".csv", ".json", ""])
def test_file_formats(spark, tmp_path, suffix):
    path = str(tmp_path / f"data{suffix}")
    df = synthetic_observations(spark, 50, cities=("A", " B "))
    if suffix == ".csv":
        sinks.write_csv(df, path)
    elif suffix == ".json":
        df.write.json(path)
    else:
        sinks.write_parquet(df, path)
    out = readers.read_observations(spark, "file", path=path)
    assert out.columns == RAW_OBSERVATION.names
    assert rows(out, *out.columns) == rows(df, *df.columns)


def test_dispatch(spark, tmp_path):
    assert readers.read_observations(spark, "synthetic", n=3).count() == 3
    sinks.publish_to_files(sinks.as_messages(synthetic_observations(spark, 5)), str(tmp_path / "m"))
    assert readers.read_observations(spark, "messages", path=str(tmp_path / "m")).count() == 5
    stream = readers.read_observations(spark, "messages", "streaming", path=str(tmp_path / "m"))
    assert stream.isStreaming and stream.columns == RAW_OBSERVATION.names
    with pytest.raises(ValueError):
        readers.read_observations(spark, "pigeon")


def test_kafka_options():
    options = readers.kafka_options("host:1", "topic", 1000, minPartitions="64")
    assert options["startingOffsets"] == "earliest" and options["failOnDataLoss"] == "false"
    assert options["maxOffsetsPerTrigger"] == "1000" and options["minPartitions"] == "64"
    assert "maxOffsetsPerTrigger" not in readers.kafka_options("host:1", "topic")


def test_synthetic_is_seeded_and_clean(spark):
    a, b = (synthetic_observations(spark, 500, ("Hanoi", "HoChiMinh", "DaNang"), seed=3) for _ in range(2))
    assert rows(a) == rows(b) and a.select("City").distinct().count() == 3
    assert a.first()["datetime"] == "2016-01-01 00:00:00"
    assert clean_observations(a).count() == 500


def test_lake_cold_start_filter_limit_and_merge(spark, tmp_path):
    path = str(tmp_path / "lake")
    assert readers.load_observations(spark, path).schema == OBSERVATION
    df = normalize_observations(clean_observations(synthetic_observations(spark, 100, ("A", "B"))))
    sinks.write_lake(df, path)
    sinks.write_parquet(df.withColumn("extra", F.lit(1)), path, mode="append", by_day=True)
    assert "extra" in readers.load_observations(spark, path, merge_schema=True).columns
    assert readers.load_observations(spark, path, city="A").select("city").distinct().count() == 1
    first = readers.load_observations(spark, path, limit=2)
    assert {r["datetime"] for r in first.collect()} == {datetime(2016, 1, 1)}
    spark.conf.set("spark.sql.maxMetadataStringLength", 4000)
    plan = readers.load_observations(spark, path, city="A").filter("obs_date = '2016-01-02'")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(city,A)" in text and "PartitionFilters: [isnotnull(obs_date" in text


def test_lake_text_times_are_parsed(spark, tmp_path):
    synthetic_observations(spark, 3).withColumnRenamed("City", "city").write.parquet(str(tmp_path / "t"))
    out = readers.load_observations(spark, str(tmp_path / "t"))
    assert out.schema["datetime"].dataType.typeName() == "timestamp" and out.filter("datetime IS NULL").isEmpty()


def test_messages(spark):
    df = spark.createDataFrame(
        [("2024-01-01 23:00:00", "A", "1.5", "x", None, None, "2", "3")],
        ", ".join(f"{c} string" for c in RAW_OBSERVATION.names),
    )
    key, value = sinks.as_messages(df).first()
    assert key == "A"
    assert json.loads(value) == {
        "datetime": "2024-01-01 23:00:00", "City": "A", "temperature": 1.5, "humidity": None, "pressure": None,
        "weather_desc": None, "wind_direction": 2.0, "wind_speed": 3.0,
    }
    moved = sinks.as_messages(df, "offset", "INTERVAL 2 HOURS").first()["value"]
    assert json.loads(moved)["datetime"] == "2024-01-02 01:00:00"
    now = json.loads(sinks.as_messages(df, "now").first()["value"])["datetime"]
    assert datetime.strptime(now, "%Y-%m-%d %H:%M:%S").year >= 2024
    with pytest.raises(ValueError):
        sinks.as_messages(df, "later")


def test_paths():
    assert sinks.lake_path("s3a://bucket/", "enriched", "weather") == "s3a://bucket/enriched/weather"
    assert sinks.lake_path("/data", "ml", "x") == "/data/ml/x"


def test_upsert_rewrites_only_touched_days(spark, tmp_path):
    path = str(tmp_path / "predictions")
    df = normalize_observations(clean_observations(synthetic_observations(spark, 72)))
    sinks.upsert_predictions(df.withColumn("prediction_temperature", F.lit(1.0)), path)
    files = {p.name for p in (tmp_path / "predictions" / "obs_date=2016-01-01").glob("*.parquet")}
    later = df.filter("datetime >= '2016-01-03 12:00:00'").withColumn("prediction_temperature", F.lit(2.0))
    sinks.upsert_predictions(later.union(later), path)
    out = readers.read_predictions(spark, path)
    assert out.columns == PREDICTION.names and out.count() == 72
    assert out.filter("prediction_temperature = 2").count() == 12
    assert {p.name for p in (tmp_path / "predictions" / "obs_date=2016-01-01").glob("*.parquet")} == files


def test_upsert_reads_changed_days_only_and_keeps_rows_without_time(spark, tmp_path):
    from stationflow.sources.sinks import DAY

    path = str(tmp_path / "predictions")
    df = normalize_observations(clean_observations(synthetic_observations(spark, 48)))
    untimed = df.limit(2).withColumn("datetime", F.lit(None).cast("timestamp")).withColumn("city", F.concat(F.lit("N"), F.col("temperature").cast("string")))
    sinks.upsert_predictions(df.unionByName(untimed), path)
    sinks.upsert_predictions(untimed.withColumn("city", F.concat(F.lit("M"), "city")), path)
    out = readers.read_predictions(spark, path)
    assert out.count() == 52 and out.filter("datetime IS NULL").count() == 4
    days = [r[0] for r in out.select(F.to_date("datetime")).distinct().limit(1).collect()]
    plan = readers.read_lake(spark, path).filter(F.col(DAY).isin(days))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and DAY in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_lake_keeps_columns_of_later_files(spark, tmp_path):
    df = normalize_observations(clean_observations(synthetic_observations(spark, 10)))
    sinks.write_parquet(df.select("datetime", "city"), str(tmp_path / "lake"))
    df.write.mode("append").parquet(str(tmp_path / "lake"))
    assert readers.load_observations(spark, str(tmp_path / "lake")).filter("temperature IS NOT NULL").count() == 10


def test_jdbc_failures(spark):
    df = spark.range(1).withColumn("city", F.lit("A"))
    assert jdbc_column_types(df.schema) == "city VARCHAR(255)"
    target = ("jdbc:nowhere:none", "t", {"driver": "no.such.Driver"})
    assert sinks.write_jdbc(df, *target, on_error="report") is False
    with pytest.raises(Exception):
        sinks.write_jdbc(df, *target)


def test_no_temporary_folder_on_a_cluster(spark, monkeypatch):
    from stationflow import session

    class Context:
        master = "spark://host:7077"

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(RuntimeError):
        session.shared_dir(Session())
    monkeypatch.setattr(Conf, "get", lambda self, key, default=None: "hdfs://x/ckpt/")
    assert session.shared_dir(Session(), "a").startswith("hdfs://x/ckpt/a/")
