from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from stationflow.config import TARGETS
from stationflow.operators import combine
from stationflow.plans.forecast import forecast, last_known

SHAPE = "datetime timestamp, city string, temperature double, weather_desc string"
T = [datetime(2024, 1, 1, h, 30) for h in range(4)]


@pytest.fixture
def readings(spark):
    made = [(T[0], "A", 1.0, "x"), (T[2], "A", 3.0, None), (T[1], "A", 2.0, "y"), (T[2], "B", None, "z")]
    return spark.createDataFrame(made, SHAPE)


def test_latest(readings):
    assert rows(combine.latest_per_city(readings), "city") == [(T[2], "A", 3.0, None), (T[2], "B", None, "z")]
    assert rows(combine.latest_overall(readings)) == [(T[2], "A", 3.0, None)]
    assert [r["datetime"] for r in combine.earliest_rows(readings, 2).collect()] == [T[0], T[1]]
    assert combine.earliest_rows(readings, None).count() == 4


def test_latest_breaks_ties_by_the_row(spark):
    df = spark.createDataFrame([(T[0], "A", t, "d") for t in (1.0, 5.0, 3.0)], SHAPE)
    assert combine.latest_per_city(df).first()["temperature"] == 5.0


def test_latest_combines_before_the_shuffle(readings):
    plan = combine.latest_per_city(readings)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_horizon(readings):
    one = readings.filter("city = 'B'")
    days = rows(combine.expand_horizon(one, 7), "datetime")
    assert [d[0] for d in days] == [datetime(2024, 1, d) for d in range(2, 9)]
    kept = rows(combine.expand_horizon(one, 2, keep_time=True), "datetime")
    assert [d[0] for d in kept] == [datetime(2024, 1, d, 2, 30) for d in (2, 3)]


def test_forecast_scopes(readings):
    def scorer(df):
        return df.withColumn("prediction_temperature", F.col("temperature") + 1)

    out = rows(forecast(readings, ["temperature"], scorer), "city", "datetime")
    assert len(out) == 7 and {r[1] for r in out} == {"A"} and {r[2] for r in out} == {4.0}
    assert last_known(readings, ["temperature"], "global").first()["city"] == "A"
    with pytest.raises(ValueError):
        last_known(readings, ["temperature"], "region")


def test_union_types_nulls_as_the_column(readings):
    history = readings.withColumn("prediction_weather_desc", F.lit("p"))
    future = readings.select("datetime", "city", F.lit("q").alias("prediction_weather_desc"))
    out = combine.history_plus_future(history, future, ["temperature", "weather_desc"])
    assert out.schema["weather_desc"].dataType.typeName() == "string"
    assert out.count() == 8 and out.filter("prediction_weather_desc = 'q' AND weather_desc IS NULL").count() == 4


def test_export_columns_in_order(readings):
    assert combine.export_columns(readings.withColumn("extra", F.lit(1)), TARGETS).columns == readings.columns


def test_category_codes(spark):
    df = spark.createDataFrame([("rain", "snow"), ("clear", None), (None, "rainy"), ("", "r")], "weather_desc string, prediction_weather_desc string")
    assert rows(combine.category_codes(df), "code") == [("", 0), ("clear", 1), ("r", 2), ("rain", 3), ("rainy", 4), ("snow", 5)]
    coded = rows(combine.with_category_codes(df).select("actual_code", "predicted_code"), "actual_code")
    assert coded == [(None, 4), (0, 2), (1, None), (3, 5)]


def test_codes_of_texts_with_a_common_start(spark):
    df = spark.range(300).select(F.format_string("https://example.com/%05d", F.col("id") * 7 % 300).alias("u"))
    codes = rows(combine.dense_codes(df, "u"), "u")
    assert [c for _, c in codes] == list(range(300))


def test_split_ignores_the_time_zone(spark):
    df = spark.range(500).select(F.timestamp_seconds(F.col("id") * 3600).alias("datetime"), F.lit("A").alias("city"))
    here = rows(combine.hash_split(df)[0].select(F.unix_micros("datetime")), "unix_micros(datetime)")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert rows(combine.hash_split(df)[0].select(F.unix_micros("datetime")), "unix_micros(datetime)") == here
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_upsert(readings):
    new = readings.filter("city = 'A'").withColumn("temperature", F.lit(9.0))
    out = combine.upsert(readings, new)
    assert out.count() == 4 and out.filter("temperature = 9").count() == 3


def test_hash_split_is_a_partition_and_stable(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("city"), F.lit("t").alias("datetime"))
    train, test = combine.hash_split(df)
    assert train.count() + test.count() == 5000 and train.intersect(test).isEmpty()
    assert abs(train.count() / 5000 - 0.8) < 0.03
    assert rows(combine.hash_split(df.repartition(7))[0], "city") == rows(train, "city")
    a, b = combine.random_split(df)
    assert a.count() + b.count() == 5000
