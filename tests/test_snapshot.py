"""Snapshots of the current state: a replay or a crash at any moment changes nothing."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from stationflow.config import StateConfig
from stationflow.sources import readers, sinks, storage
from stationflow.sources.synthetic import synthetic_observations
from stationflow.streaming import control, etl, snapshot

WRITTEN = datetime(2024, 1, 1, 12)


def batch(spark, *made, written=WRITTEN):
    df = spark.createDataFrame(list(made), "datetime string, city string, temperature double")
    return df.select(F.col("datetime").cast("timestamp").alias("datetime"), "city", "temperature", F.lit(written).alias("written_at"))


def state(spark, path, now=WRITTEN, **options):
    df = snapshot.read_snapshot(spark, path, now, **options)
    return rows(df.select("key", "reading.temperature", "written_at"), "key")


FIRST = [("2024-01-01 10:00:00", "A", 1.0), ("2024-01-01 09:00:00", "A", 2.0), ("2024-01-01 09:00:00", "B", 3.0)]
SECOND = [("2024-01-01 08:00:00", "A", 4.0), ("2024-01-01 11:00:00", "B", 5.0), ("2024-01-01 11:00:00", "C", 6.0)]


def test_batches_merge_by_event_time(spark, tmp_path):
    path = str(tmp_path)
    assert snapshot.write_snapshot_batch(batch(spark, *FIRST), 0, path)
    assert snapshot.write_snapshot_batch(batch(spark, *SECOND), 1, path)
    assert state(spark, path) == [("weather:current:A", 1.0, WRITTEN), ("weather:current:B", 5.0, WRITTEN), ("weather:current:C", 6.0, WRITTEN)]
    assert not snapshot.write_snapshot_batch(batch(spark, *SECOND).limit(0), 2, path)
    assert snapshot.pointers(spark, path) == [0, 1]


def test_a_committed_batch_is_skipped_on_replay(spark, tmp_path):
    path = str(tmp_path)
    for batch_id, made in ((0, FIRST), (1, SECOND)):
        snapshot.write_snapshot_batch(batch(spark, *made), batch_id, path)
    want = state(spark, path)
    for batch_id, made in ((0, FIRST), (1, SECOND)):
        assert not snapshot.write_snapshot_batch(batch(spark, *made), batch_id, path)
    assert state(spark, path) == want


@pytest.mark.parametrize("moment", ["before the pointer", "while writing"])
def test_a_crash_changes_nothing_and_the_replay_gives_the_same(spark, tmp_path, monkeypatch, moment):
    safe, path = str(tmp_path / "safe"), str(tmp_path / "crashed")
    for folder in (safe, path):
        snapshot.write_snapshot_batch(batch(spark, *FIRST), 0, folder)
    snapshot.write_snapshot_batch(batch(spark, *SECOND), 1, safe)
    before = state(spark, path)
    if moment == "before the pointer":
        with monkeypatch.context() as patch:
            patch.setattr(storage, "publish_text", lambda *_: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError, match="lost"):
                snapshot.write_snapshot_batch(batch(spark, *SECOND), 1, path)
    else:
        batch(spark, ("2024-01-01 23:00:00", "Z", 9.0)).write.parquet(f"{path}/snapshots/batch=1")
    assert state(spark, path) == before
    assert snapshot.write_snapshot_batch(batch(spark, *SECOND), 1, path)
    assert state(spark, path) == state(spark, safe)


def test_lifetime_counts_from_the_write(spark, tmp_path):
    path, config = str(tmp_path), StateConfig(ttl_seconds=60)
    snapshot.write_snapshot_batch(batch(spark, *FIRST), 0, path, config)
    assert len(state(spark, path, WRITTEN + timedelta(seconds=59), config=config)) == 2
    assert state(spark, path, WRITTEN + timedelta(seconds=60), config=config) == []
    later = WRITTEN + timedelta(seconds=90)
    snapshot.write_snapshot_batch(batch(spark, ("2024-01-01 07:00:00", "A", 7.0), written=later), 1, path, config)
    # The older entry had expired, so even an older reading is the state now, as with a key that expires.
    assert state(spark, path, later, config=config) == [("weather:current:A", 7.0, later)]


def test_old_snapshots_go_after_the_switch(spark, tmp_path):
    path = str(tmp_path)
    for n in range(5):
        snapshot.write_snapshot_batch(batch(spark, (f"2024-01-01 1{n}:00:00", "A", float(n))), n, path, keep=2)
    assert snapshot.pointers(spark, path) == [3, 4]
    assert storage.names(spark, f"{path}/snapshots") == ["batch=3", "batch=4"]
    assert state(spark, path) == [("weather:current:A", 4.0, WRITTEN)]


def test_no_state_yet(spark, tmp_path):
    assert snapshot.read_snapshot(spark, str(tmp_path / "none")).isEmpty()


def test_stream_and_its_last_batch_again(spark, tmp_path):
    feed, path, checkpoint = str(tmp_path / "feed"), str(tmp_path / "state"), tmp_path / "checkpoint"
    for start in ("2024-01-02 00:00:00", "2024-01-01 00:00:00", "2024-01-03 00:00:00"):
        sinks.publish_to_files(sinks.as_messages(synthetic_observations(spark, 20, ("A", "B"), start=start).coalesce(1)), feed)
    stream = etl.clean_stream(readers.read_message_files(spark, feed, max_files_per_trigger=1))

    def run():
        control.drain(snapshot.start_snapshot_sink(stream, path, str(checkpoint), every=None))
        return rows(snapshot.read_snapshot(spark, path).select("city", "reading.datetime", "written_at"), "city")

    want = run()
    newest = readers.decode_messages(readers.read_message_files(spark, feed, streaming=False)).groupBy("City").agg(F.max("datetime"))
    assert [(c, str(t)) for c, t, _ in want] == rows(newest, "City")
    # The last batch was stored, but the query did not get to know of it; then its pointer is lost as well.
    last = max(int(p.name) for p in (checkpoint / "commits").iterdir() if p.name.isdigit())
    for lose_pointer in (False, True):
        (checkpoint / "commits" / str(last)).unlink()
        (checkpoint / "commits" / f".{last}.crc").unlink(missing_ok=True)
        if lose_pointer:
            storage.delete(spark, f"{path}/pointers/{snapshot.pointers(spark, path)[-1]:020d}")
        assert run() == want
