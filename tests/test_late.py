"""Late rows have a table of their own; no key is lost and none comes twice."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from stationflow.sources import readers, sinks
from stationflow.sources.synthetic import synthetic_observations
from stationflow.streaming import control, etl, late


@pytest.fixture
def run(spark, tmp_path):
    """Adds messages and runs the stream over them; returns the query, the lake and the late table."""
    feed, lake, kept_aside, checkpoint = (str(tmp_path / n) for n in ("feed", "lake", "late", "checkpoint"))

    def add(df, delay="2 hours"):
        sinks.publish_to_files(sinks.as_messages(df.coalesce(1)), feed)
        query = late.start_late_aware_sink(readers.read_message_files(spark, feed), lake, kept_aside, checkpoint, delay, every=None)
        control.drain(query)
        return query, late.read_stored(spark, lake), late.read_stored(spark, kept_aside)

    return feed, add


KEY = ("datetime", "city")


def test_on_time_and_late_are_all_keys_once(spark, run):
    feed, add = run
    new, old = (synthetic_observations(spark, 10, ("A",), start=f"2024-01-0{d} 00:00:00") for d in (3, 1))
    _, lake, aside = add(new.union(new))
    assert (lake.count(), aside.count()) == (10, 0)
    _, lake, aside = add(old.union(old).union(new))
    assert (lake.count(), aside.count()) == (10, 10)
    assert rows(aside.select("datetime"), "datetime")[0][0].day == 1
    query, lake, aside = add(old.union(synthetic_observations(spark, 5, ("B",), start="2024-01-03 08:00:00")))
    assert (lake.count(), aside.count()) == (15, 10)
    want = etl.clean_stream(readers.read_message_files(spark, feed, streaming=False)).select(*KEY)
    assert rows(lake.select(*KEY).union(aside.select(*KEY)), *KEY) == rows(want, *KEY)


def test_the_state_forgets_what_the_delay_allows(spark, run):
    _, add = run
    for day in (1, 2, 3, 4):
        query, lake, _ = add(synthetic_observations(spark, 20, ("A",), start=f"2024-01-0{day} 00:00:00"))
    assert lake.count() == 80
    assert max(op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]) <= 45


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    lake, aside = str(tmp_path / "lake"), str(tmp_path / "late")
    made = etl.normalize_observations(etl.clean_observations(synthetic_observations(spark, 12, ("A", "B"))))
    first, rest = made.filter("city = 'A'"), made.filter("city = 'B'")

    def marked(kept, came):
        return kept.withColumn("_kept", F.lit(True)).unionByName(came.withColumn("_kept", F.lit(False)))

    batches = [marked(first, first.union(first)), marked(first.limit(0), made), marked(first.limit(0), rest)]
    for order in ((0, 1, 2), (1, 2), (2,)):
        for n in order:
            late.write_with_late(batches[n], n, lake, aside)
    assert rows(late.read_stored(spark, lake).select(*KEY), *KEY) == rows(first.select(*KEY), *KEY)
    assert rows(late.read_stored(spark, aside).select(*KEY), *KEY) == rows(rest.select(*KEY), *KEY)
    assert rows(late.read_stored(spark, aside).select("batch_id").distinct()) in ([(1,)], [])
