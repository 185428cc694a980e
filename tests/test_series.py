"""Split series must equal plain windows, whatever the skew and the gaps."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from stationflow.config import SplitConfig
from stationflow.operators.enrich import with_trend
from stationflow.operators.features import build_features, feature_names
from stationflow.operators.series import fill_series, over_series, with_positions

PLAIN = SplitConfig(rows_per_segment=10**9)


def skewed(spark, n=3000):
    """One station with a third of the rows, many small ones, irregular gaps and bursts."""
    stamp = F.expr("timestamp_seconds(1700000000 + id * 1800 + (id % 7) * 600 + IF(id % 500 > 420, id * 40000, 0))")
    return spark.range(n).select(
        stamp.alias("datetime"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 41).cast("string"))).alias("city"),
        (F.rand(1) * 40).alias("temperature"),
        F.when(F.rand(2) > 0.2, F.rand(3) * 100).alias("humidity"),
        (F.rand(4) * 50 + 980).alias("pressure"),
        (F.rand(5) * 30).alias("wind_speed"),
        (F.rand(6) * 360).alias("wind_direction"),
    )


@pytest.fixture(scope="module")
def readings(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("series") / "t")
    skewed(spark).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("per_segment", [1, 7, 30, 400])
def test_features_split_equals_plain(readings, per_segment):
    split = SplitConfig(rows_per_segment=per_segment)
    plain, cut = build_features(readings, split=PLAIN), build_features(readings, split=split)
    assert cut.columns == plain.columns
    assert rows(cut, "city", "datetime") == rows(plain, "city", "datetime")


def test_trend_split_equals_plain(readings):
    window = Window.partitionBy("city").orderBy("datetime")
    plain = readings.withColumn("temp_lag_1", F.lag("temperature").over(window)).select("city", "datetime", "temp_lag_1")
    cut = with_trend(readings, split=SplitConfig(rows_per_segment=5)).select("city", "datetime", "temp_lag_1")
    assert rows(cut, "city", "datetime") == rows(plain, "city", "datetime")


@pytest.mark.parametrize("per_segment", [10, 500])
def test_segments_are_bounded_with_all_rows_on_one_day(spark, per_segment):
    day = spark.range(4000).select(
        F.expr("timestamp_micros(1700000000000000 + id * 20000000 + IF(id % 3 = 0, 7, 0))").alias("datetime"), F.lit("one").alias("city"), F.col("id").alias("event")
    )
    split = SplitConfig(rows_per_segment=per_segment)
    sized = over_series(
        day,
        lambda w: {"n": F.count("*").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), "before": F.lag("event").over(w)},
        lookback=24,
        tie=["event"],
        split=split,
    )
    most, wrong = sized.agg(F.max("n"), F.count_if((F.col("before") != F.col("event") - 1))).first()
    assert most <= per_segment + 24 and wrong == 0 and sized.count() == 4000


@pytest.mark.parametrize("per_segment", [3, 100, 10**9])
def test_fill_split_equals_plain(readings, per_segment):
    sparse = readings.withColumn("humidity", F.when(F.col("humidity") < 10, F.col("humidity")))
    filled = fill_series(sparse, ["humidity", "pressure"], split=SplitConfig(rows_per_segment=per_segment))
    assert filled.columns == sparse.columns
    window = Window.partitionBy("city").orderBy("datetime")
    last = F.last("humidity", True).over(window)
    plain = sparse.withColumn("humidity", F.coalesce(last, F.first("humidity", True).over(window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    assert rows(filled.select("city", "datetime", "humidity"), "city", "datetime") == rows(plain.select("city", "datetime", "humidity"), "city", "datetime")


def test_null_keys_are_not_lost(spark, readings):
    odd = readings.limit(50).withColumn("city", F.when(F.col("temperature") > 20, F.col("city")))
    split = SplitConfig(rows_per_segment=5)
    assert with_trend(odd, split=split).count() == 50
    assert fill_series(odd, ["humidity"], split=split).count() == 50


def test_staged_ranges_can_be_dropped(spark, readings):
    from stationflow.session import drop_staged

    assert with_trend(readings).count() == 3000
    assert drop_staged(spark) > 0 and drop_staged(spark) == 0


def shuffles_of_windows(df):
    """Exchanges of whole rows after the staged ranges; sizes of ranges are one row each."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    return sum("Exchange hashpartitioning(city" in line for line in plan.splitlines()), plan.count("SortMergeJoin")


def test_windows_shuffle_rows_once(readings):
    assert shuffles_of_windows(with_trend(readings)) == (1, 0)
    assert shuffles_of_windows(build_features(readings)) == (1, 0)


def test_rows_are_numbered_in_the_order_of_the_table(readings):
    numbered = with_positions(readings, "city", ["datetime"])
    got = [r["_row"] for r in numbered.orderBy("city", "datetime").collect()]
    assert got == list(range(3000))


def test_feature_table_shape(readings):
    table = build_features(readings)
    names = feature_names(table)
    assert len(names) == 71
    assert not set(names) & {"season", "pressure_tendency", "temperature", "city"}
    assert "temperature" in feature_names(table, exclude_targets=False)


def test_lags_count_rows_and_first_row_has_no_deviation(readings):
    first = build_features(readings).orderBy("city", "datetime").first()
    assert first["temperature_lag_1h"] is None and first["temperature_rolling_std_6h"] is None
    assert first["temperature_rolling_mean_6h"] == first["temperature"]
    assert first["pressure_tendency"] == "stable" and first["temp_change_1h"] is None


def test_absent_measures_are_skipped(readings):
    table = build_features(readings.drop("humidity", "wind_speed"))
    assert "heat_index" not in table.columns and "wind_chill" not in table.columns
    assert "humidity_lag_1h" not in table.columns and "pressure_lag_1h" in table.columns
