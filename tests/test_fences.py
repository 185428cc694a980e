"""Sketched fences per station, and the split by time."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import rows
from stationflow.config import SketchConfig
from stationflow.operators import combine, outliers


def values(spark, made):
    return spark.createDataFrame(made, "city string, day int, v double")


def exact(numbers):
    numbers = sorted(numbers)
    return tuple(numbers[max(math.ceil(p * len(numbers)), 1) - 1] for p in (0.25, 0.75))


@pytest.fixture
def stations(spark):
    made = [("A", i % 5, float(i * 37 % 101)) for i in range(101)] + [("B", 1, 2.0)] * 3 + [("B", 2, None), ("B", 2, float("nan"))]
    made += [(None, 1, float(i)) for i in range(8)] + [("C", 1, None), ("D", 1, float("inf")), ("D", 1, 1.0), ("D", 2, 2.0), ("D", 2, 3.0)]
    return made, values(spark, made)


@pytest.mark.parametrize("by", [[], ["day"]])
def test_small_stations_are_exact(stations, by):
    made, df = stations
    got = {r["city"]: (r["n"], r["q1"], r["q3"], r["low"], r["high"]) for r in outliers.fences_by(df, "v", by=by).collect()}
    want = {}
    for city in {c for c, _, _ in made}:
        numbers = [v for c, _, v in made if c == city and v is not None and not math.isnan(v)]
        if numbers:
            q1, q3 = exact(numbers)
            want[city] = (len(numbers), q1, q3, q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    assert got == want


def test_rows_are_judged_by_their_own_station(spark, monkeypatch):
    made = [("hot", 1, 30.0 + i % 3) for i in range(30)] + [("cold", 1, -30.0 + i % 3) for i in range(30)]
    made += [("hot", 1, -30.0), ("cold", 1, 30.0), ("cold", 1, None), (None, 1, 5.0)]
    want = [r for r in made if r not in (("hot", 1, -30.0), ("cold", 1, 30.0), ("cold", 1, None))]
    kept = outliers.without_outliers_by(values(spark, made), "v")
    assert kept.columns == ["city", "day", "v"]
    assert sorted(map(str, rows(kept))) == sorted(map(str, want))
    monkeypatch.setattr(outliers, "MOST_BROADCAST_FENCES", 0)
    assert outliers.without_outliers_by(values(spark, made), "v").count() == len(want)


@pytest.mark.parametrize("by", [[], ["day"]])
def test_large_stations_stay_within_the_stated_error(spark, by):
    n, k = 200_000, 256
    df = spark.range(n, numPartitions=8).select((F.col("id") % 2).cast("string").alias("city"), (F.col("id") % 10).cast("int").alias("day"), (F.col("id") * 7919 % n).cast("double").alias("v"))
    for r in outliers.fences_by(df, "v", by=by, config=SketchConfig(k)).collect():
        # The values of a station are all even or all odd numbers below n.
        for name, share in (("q1", 0.25), ("q3", 0.75)):
            assert abs(r[name] / n - share) <= 2.5 / k


def test_sketches_can_be_stored_and_merged_later(spark, stations, tmp_path):
    _, df = stations
    outliers.value_sketches(df, "v", ["city", "day"]).write.parquet(str(tmp_path / "s"))
    merged = outliers.merge_sketches(spark.read.parquet(str(tmp_path / "s")), ["city"])
    columns = ["city", "n", "q1", "q3"]
    assert rows(outliers.sketch_fences(merged).select(*columns), "city") == rows(outliers.fences_by(df, "v").select(*columns), "city")


def test_fences_of_the_whole_column(spark):
    made = values(spark, [("A", 1, float(v)) for v in (1, 2, 3, 4, 100)] + [("A", 1, None)])
    assert rows(outliers.without_outliers(made, "v", sketch=SketchConfig()).select("v"), "v") == [(1.0,), (2.0,), (3.0,), (4.0,)]
    assert outliers.iqr_bounds(made.limit(0), "v", sketch=SketchConfig()) is None
    assert outliers.without_outliers(made.filter("v IS NULL"), "v", sketch=SketchConfig()).count() == 1


def times(spark, made):
    return spark.createDataFrame([(m,) for m in made], "m int").select(F.timestamp_seconds(F.lit(1_700_000_000) + F.col("m") * 60).alias("datetime"))


@pytest.mark.parametrize("fraction", [0.1, 0.5, 0.8, 1.0])
@pytest.mark.parametrize("made", [[1, 2, 3, 4, 5, 6], [1, 1, 1, 1, 2], [2, 1, 1], [3, 3, 3], [5], [7, 1, 7, 1, 7, 3, 3, 3, 9, 0, 0]])
def test_time_split_is_the_percent_rank(spark, made, fraction):
    df = times(spark, made)
    train, test = combine.time_split(df, fraction)
    df.createOrReplaceTempView("timed")
    ranked = spark.sql("SELECT datetime, percent_rank() OVER (ORDER BY datetime) AS share FROM timed")
    assert rows(train, "datetime") == rows(ranked.filter(F.col("share") < fraction).select("datetime"), "datetime")
    assert rows(test, "datetime") == rows(ranked.filter(F.col("share") >= fraction).select("datetime"), "datetime")


def test_time_split_of_nothing_and_of_rows_without_time(spark):
    assert [d.count() for d in combine.time_split(times(spark, []))] == [0, 0]
    assert [d.count() for d in combine.time_split(times(spark, [None, None]))] == [2, 0]
    assert [d.count() for d in combine.time_split(times(spark, [1, 2, None]), 0.5)] == [2, 1]
    assert [d.count() for d in combine.time_split(times(spark, [1, 2]), 0.0)] == [0, 2]


def test_time_split_reaches_the_scan(spark, tmp_path):
    times(spark, range(100)).write.parquet(str(tmp_path / "t"))
    for part in combine.time_split(spark.read.parquet(str(tmp_path / "t"))):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "Than" in plan.split("PushedFilters:")[1] and "Window" not in plan
