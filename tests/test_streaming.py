import json
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from stationflow.config import StateConfig
from stationflow.operators import serving
from stationflow.operators.clean import dedupe
from stationflow.sources import readers, sinks
from stationflow.sources.synthetic import synthetic_observations
from stationflow.streaming import control, etl, state


@pytest.fixture
def feed(spark, tmp_path):
    """Folder of message files and a function that adds readings to it."""
    folder = tmp_path / "feed"
    folder.mkdir()

    def add(df):
        sinks.publish_to_files(sinks.as_messages(df), str(folder))

    return str(folder), add


def run_lake(spark, feed_path, tmp_path, **options):
    stream = etl.clean_stream(readers.read_message_files(spark, feed_path), **options)
    control.drain(etl.start_lake_sink(stream, str(tmp_path / "lake"), str(tmp_path / "ck"), every=None))
    return readers.load_observations(spark, str(tmp_path / "lake")).drop("obs_date")


@pytest.mark.parametrize("spread", [1, 8])
@pytest.mark.parametrize("delay", ["60 days", None])
def test_stream_equals_batch_and_restart_adds_nothing(spark, feed, tmp_path, spread, delay):
    path, add = feed
    raw = synthetic_observations(spark, 200, ("A", "B"))
    add(raw.union(raw).union(raw.limit(50)).repartition(5))
    want = etl.clean_stream(readers.read_message_files(spark, path, streaming=False))
    out = run_lake(spark, path, tmp_path, delay=delay, spread=spread)
    columns = sorted(want.columns)
    assert rows(out.select(*columns), *columns) == rows(want.select(*columns), *columns)
    assert run_lake(spark, path, tmp_path, delay=delay, spread=spread).count() == 200
    add(raw.limit(20).union(synthetic_observations(spark, 10, ("C",))))
    assert run_lake(spark, path, tmp_path, delay=delay, spread=spread).count() == 210


def test_disk_state_store(spark, feed, tmp_path):
    from stationflow.plans.stream import STATE_STORE

    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, STATE_STORE)
    try:
        path, add = feed
        raw = synthetic_observations(spark, 50, ("A", "B"))
        add(raw.union(raw))
        assert run_lake(spark, path, tmp_path).count() == 50
    finally:
        spark.conf.set(key, before)


def test_late_rows_fall_to_the_watermark(spark, feed, tmp_path):
    path, add = feed
    add(synthetic_observations(spark, 10, ("A",), start="2024-01-02 00:00:00"))
    assert run_lake(spark, path, tmp_path, delay="1 hour").count() == 10
    add(synthetic_observations(spark, 10, ("A",), start="2024-01-01 00:00:00"))
    add(synthetic_observations(spark, 1, ("A",), start="2024-01-03 00:00:00"))
    assert run_lake(spark, path, tmp_path, delay="1 hour").count() == 11


def test_files_out_of_step_lose_nothing_by_default(spark, feed, tmp_path):
    path, add = feed
    for day in ("2024-01-03", "2024-01-01", "2024-01-04", "2024-01-02"):
        add(synthetic_observations(spark, 24, (f"S{day[-1]}",), start=f"{day} 00:00:00").coalesce(1))
        run_lake(spark, path, tmp_path)
    assert run_lake(spark, path, tmp_path).count() == 96


def readings(spark, *made):
    df = spark.createDataFrame(list(made), "datetime string, city string, temperature double")
    return df.withColumn("datetime", F.col("datetime").cast("timestamp"))


def test_state_keeps_newest_by_event_time(spark, tmp_path):
    path = str(tmp_path / "state")
    state.write_state_batch(readings(spark, ("2024-01-01 10:00:00", "A ", 1.0), ("2024-01-01 09:00:00", "A ", 2.0)), 0, path)
    state.write_state_batch(readings(spark, ("2024-01-01 08:00:00", "A ", 3.0), ("2024-01-01 08:00:00", "B", 4.0)), 1, path)
    for _ in range(2):  # a replayed batch changes nothing
        state.write_state_batch(readings(spark, ("2024-01-01 08:00:00", "B", 4.0)), 1, path)
    state.write_state_batch(readings(spark, ("2024-01-01 08:00:00", "B", 4.0)).limit(0), 2, path)
    current = state.read_state(spark, path)
    assert rows(current.select("key", "reading.temperature"), "key") == [("weather:current:A", 1.0), ("weather:current:B", 4.0)]
    value = json.loads(current.filter("key = 'weather:current:A'").first()["value"])
    assert value == {"datetime": "2024-01-01 10:00:00", "city": "A ", "temperature": 1.0}
    later = datetime.now(UTC).replace(tzinfo=None) + timedelta(seconds=3601)
    assert state.read_state(spark, path, now=later).isEmpty()
    assert state.expired_hours(spark, path) == []
    gone = datetime.now(UTC).replace(tzinfo=None) + timedelta(hours=3)
    assert len(state.expired_hours(spark, path, gone)) >= 1
    assert state.drop_expired(spark, path, gone) and state.expired_hours(spark, path, gone) == []
    assert state.read_state(spark, path).isEmpty()
    assert state.read_state(spark, str(tmp_path / "none")).isEmpty()


def test_two_sinks_from_one_stream(spark, feed, tmp_path):
    path, add = feed
    raw = synthetic_observations(spark, 60, ("A", "B"))
    add(raw)
    queries = etl.start_etl(
        readers.read_message_files(spark, path), str(tmp_path / "lake"), str(tmp_path / "state"), str(tmp_path / "ck"),
        lake_every=None, state_every=None,
    )
    control.drain(*queries)
    lake = readers.load_observations(spark, str(tmp_path / "lake"))
    assert lake.count() == 60
    current = state.read_state(spark, str(tmp_path / "state"))
    newest = lake.groupBy("city").agg(F.max("datetime").alias("datetime"))
    assert rows(current.select("city", "reading.datetime"), "city") == rows(newest, "city")


def test_console_memory_and_stop(spark, feed):
    path, add = feed
    add(synthetic_observations(spark, 5))
    stream = etl.clean_stream(readers.read_message_files(spark, path))
    query = etl.start_console(stream, "shown", rows=2, every=None)
    control.wait_any(spark, 60)
    control.drain(query)
    spark.streams.resetTerminated()
    stream.writeStream.format("memory").queryName("kept").outputMode("append").start()
    assert control.stop_all(spark) == ["kept"]
    assert sinks.write_lake(dedupe(synthetic_observations(spark, 3), ["City"]), path + "-batch") is None


def test_reads_of_the_state(spark):
    now = F.lit("2024-01-01 12:00:00").cast("timestamp")
    df = readings(spark, ("2024-01-01 11:30:00", "B", None), ("2024-01-01 11:10:00", "A", 2.25), ("2024-01-01 10:59:00", "C", 1.0))
    table = state.as_state(df, written_at=F.col("datetime"))
    assert rows(serving.reporting_cities(table, now)) == [("A",), ("B",)]
    assert serving.current_reading(table, "B", now).first()["city"] == "B"
    assert serving.current_reading(table, None, now).first()["city"] == "A"
    assert serving.current_reading(table, "C", now).isEmpty()
    assert serving.current_readings(table, now, StateConfig(ttl_seconds=7200)).count() == 3
    cards = {r["city"]: r.asDict() for r in serving.reading_cards(serving.current_readings(table, now)).collect()}
    assert cards["A"] == {
        "city": "A", "temperature": "2.3°C", "humidity": "0%", "pressure": "0 hPa", "condition": "Unknown",
        "wind_speed": "0.0 km/h", "wind_direction": "0°", "last_update": "11:10:00",
    }
    gauges = serving.gauge_fractions(serving.current_readings(table, now)).orderBy("city").first()
    assert gauges["temperature_fraction"] == 2.25 / 50 and gauges["humidity_fraction"] == 0.0
