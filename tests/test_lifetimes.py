"""Changes of keyed state against a replay in plain Python."""

from datetime import datetime, timedelta

import pytest

from conftest import rows
from stationflow.sources import sinks
from stationflow.sources.readers import read_message_files
from stationflow.sources.synthetic import synthetic_observations
from stationflow.streaming import control, lifetimes

START = datetime(2024, 1, 1)
LIFE, DELAY = timedelta(hours=3), timedelta(hours=2)


@pytest.fixture
def run(spark, tmp_path):
    """Adds messages of ``(city, hour)`` as one batch, runs the stream to its end and returns all changes."""
    feed, path, checkpoint = (str(tmp_path / n) for n in ("feed", "changes", "checkpoint"))
    like = synthetic_observations(spark, 1, ("X",)).drop("datetime", "City")

    def add(*made):
        keys = spark.createDataFrame([(str(START + timedelta(hours=h)), c) for c, h in made], "datetime string, City string")
        sinks.publish_to_files(sinks.as_messages(keys.crossJoin(like).coalesce(1)), feed)
        control.drain(lifetimes.start_change_sink(read_message_files(spark, feed), path, checkpoint, int(LIFE.total_seconds()), "2 hours", every=None))
        return lifetimes.read_changes(spark, path)

    return add


def replay(batches):
    """Live stations after each batch: late rows are no news, ends come when the watermark passes."""
    mark, newest, moments = None, {}, []
    for made in batches:
        for city, hour in made:
            at = START + timedelta(hours=hour)
            if mark is None or at > mark:
                newest[city] = max(at, newest.get(city, at))
        latest = max(START + timedelta(hours=h) for _, h in made)
        mark = max(latest - DELAY, mark) if mark else latest - DELAY
        newest = {c: t for c, t in newest.items() if t + LIFE > mark}
        moments.append(dict(newest))
    return moments


def test_live_stations_at_every_moment_of_a_replay(run):
    batches = [
        [("A", 1), ("A", 0), ("B", 1)],
        [("B", 4), ("C", 5)],
        [("A", 3), ("A", 2), ("C", 5)],  # out of order, and known before
        [("C", 9)],  # ends A at 3 + 3 and not B
        [("A", 6), ("D", 8)],  # late, and new
        [("C", 30)],  # ends all others
        [("A", 29), ("A", 29)],
    ]
    for made, want in zip(batches, replay(batches), strict=True):
        changed = run(*made)
        assert dict(rows(lifetimes.live(changed).select("city", "datetime"))) == want
    ended = rows(changed.filter("NOT alive").select("city", "datetime"), "city", "datetime")
    assert ended == sorted(ended) and len(ended) == len(set(ended))
    assert changed.filter("alive").groupBy("city", "datetime").count().filter("count > 1").isEmpty()


def test_one_station_with_very_many_rows(run, spark):
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, 100)
    try:
        changed = run(*[("A", h % 500 / 100) for h in range(3000)])
    finally:
        spark.conf.set(setting, before)
    assert rows(changed.select("city", "datetime", "alive")) == [("A", START + timedelta(hours=4.99), True)]


def test_nothing_yet(spark, tmp_path):
    assert lifetimes.live(lifetimes.read_changes(spark, str(tmp_path / "none"))).count() == 0
