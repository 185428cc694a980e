"""Every query the library answers, over the given tables."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CATEGORY, MEASURES, TARGETS, ModelConfig, SketchConfig, SplitConfig, StateConfig
from ..functions.scores import (
    emergency_level,
    keyword_score,
    pressure_score,
    temperature_score,
    wind_score,
)
from ..operators import align, clean, combine, enrich, features, hours, metrics, outliers, quality, serving
from ..operators.normalize import normalize_observations
from ..operators.outliers import impute, without_outliers
from ..operators.series import over_series
from ..session import shared_dir, stage
from ..sources import compaction
from ..sources.events import events_as_observations, read_events
from ..sources.readers import (
    decode_messages,
    load_observations,
    read_file,
    read_message_files,
    read_observations,
    read_predictions,
    read_wide_csv,
)
from ..sources.schema_log import append_evolving
from ..sources.sinks import (
    as_messages,
    lake_path,
    load_models,
    publish_to_files,
    upsert_predictions,
    write_csv,
    write_lake,
    write_parquet,
)
from ..sources.sorted import POSITION, read_range, read_sorted, write_sorted
from ..streaming.control import drain, stop_all
from ..streaming.etl import clean_stream, start_etl, start_lake_sink, start_state_sink
from ..streaming.late import read_stored, start_late_aware_sink
from ..streaming.lifetimes import live, read_changes, start_change_sink
from ..streaming.snapshot import read_snapshot, start_snapshot_sink
from ..streaming.state import as_state, read_state
from . import trees
from .batch import BatchConfig, run_batch, run_on
from .forecast import forecast
from .models import score_with

Query = Callable[[SparkSession, str], DataFrame]

# Users that share a station where repeated keys are wanted, the station
# count of wide tables with its names, and the moment the current-reading queries look from.
USERS = 10
STATIONS = 12
WIDE_CITIES = [f"city {i}" for i in range(STATIONS)]
NOW = "2024-01-30 23:30:00"
LIFETIME = StateConfig(ttl_seconds=6 * 3600)
# Delay and lifetime of readings in the state store.
LIFE_DELAY, LIFE_SECONDS = "10 hours 10 minutes", 1800
# Event type each wide measure table leaves out, so their times differ.
LEFT_OUT = {
    "temperature": "none",
    "humidity": "view",
    "pressure": "click",
    "weather_desc": "signup",
    "wind_direction": "purchase",
    "wind_speed": "error",
}
OBSERVED = ("datetime", "city", *TARGETS)
# Fixed value: segments of hour features are short enough that given series are cut.
HOUR_SPLIT = SplitConfig(hours_per_segment=100)


def raw(spark: SparkSession, sf_dir: str, stations: int | None = None, keep=("event_id",), users: int = 1) -> DataFrame:
    return events_as_observations(read_events(spark, sf_dir), stations, keep, users)


def readings(spark: SparkSession, sf_dir: str, users: int = 1) -> DataFrame:
    """Clean, normalised readings; the earliest event of each key survives."""
    cleaned = clean.clean_observations(raw(spark, sf_dir, users=users), order_by=["event_id"])
    return normalize_observations(cleaned).select(*OBSERVED)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings as the windows take them, which store them in ranges themselves."""
    return readings(spark, sf_dir)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison, keeping column order."""
    return df.select(
        *[
            F.round(f"`{f.name}`", digits).alias(f.name) if f.dataType.typeName() == "double" else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def persistence(df: DataFrame) -> DataFrame:
    """Readings with the previous reading of the station as prediction."""
    return over_series(
        df, lambda w: {f"prediction_{t}": F.lag(t, 1).over(w) for t in TARGETS}, lookback=1
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return persistence(observations(spark, sf_dir))


def served(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.serving_view(scored(spark, sf_dir))


# -- cleaning --------------------------------------------------------------


def clean_observations(spark, sf_dir):
    return clean.clean_observations(raw(spark, sf_dir, users=USERS), order_by=["event_id"])


def normalized_observations(spark, sf_dir):
    return readings(spark, sf_dir, USERS)


def rejected_by_rule(spark, sf_dir):
    rejected = clean.rejected_observations(raw(spark, sf_dir, users=USERS))
    return rejected.groupBy("rule").agg(F.count("*").alias("n_rows"))


def rejected_rows(spark, sf_dir):
    return clean.rejected_observations(raw(spark, sf_dir)).select("event_id", "rule")


def city_readings(spark, sf_dir):
    return clean.for_city(readings(spark, sf_dir), "City 1")


def earliest_readings(spark, sf_dir):
    return combine.earliest_rows(readings(spark, sf_dir), 100)


# -- messages and files ----------------------------------------------------


def damaged_messages(spark, sf_dir):
    """Messages of which some are cut short, mistyped or misspelled, by event type."""
    source = raw(spark, sf_dir, keep=("event_type",))
    body = F.col("value")
    text = (
        F.when(F.col("event_type") == "error", F.substring(body, 1, 12))
        .when(F.col("event_type") == "signup", F.regexp_replace(body, r'"temperature":([-0-9.]+)', '"temperature":"$1"'))
        .when(F.col("event_type") == "view", F.replace(body, F.lit('"City"'), F.lit('"city"')))
        .otherwise(body)
    )
    return as_messages(source, keep=("event_type",)).select(text.alias("value"))


def json_decode(spark, sf_dir):
    messages = damaged_messages(spark, sf_dir)
    decoded = decode_messages(messages.withColumn("value", F.col("value").cast("binary")))
    return decoded.groupBy(*decoded.columns).agg(F.count("*").alias("n"))


def restamp_publish(spark, sf_dir):
    return as_messages(raw(spark, sf_dir), restamp="offset", offset="INTERVAL 36 HOURS")


def message_files(spark, sf_dir):
    path = shared_dir(spark, "messages")
    publish_to_files(as_messages(raw(spark, sf_dir)), path)
    return decode_messages(read_message_files(spark, path, streaming=False))


def csv_files(spark, sf_dir):
    path = shared_dir(spark, "csv") + ".csv"
    write_csv(raw(spark, sf_dir).drop("event_id"), path)
    return read_file(spark, path)


def json_files(spark, sf_dir):
    path = shared_dir(spark, "json") + ".json"
    raw(spark, sf_dir).drop("event_id").write.json(path)
    return read_file(spark, path)


def parquet_files(spark, sf_dir):
    path = shared_dir(spark, "raw")
    raw(spark, sf_dir).drop("event_id").write.parquet(path)
    return read_file(spark, path)


def source_dispatch(spark, sf_dir):
    """Readings per station from the same rows as files and as messages, each opened by the name of its source."""
    files, messages = shared_dir(spark, "raw") + ".json", shared_dir(spark, "messages")
    raw(spark, sf_dir).drop("event_id").write.json(files)
    publish_to_files(as_messages(raw(spark, sf_dir)), messages)
    opened = [read_observations(spark, name, path=path).withColumn("source", F.lit(name)) for name, path in (("file", files), ("messages", messages))]
    return opened[0].unionByName(opened[1]).groupBy("source", "City").agg(F.count("*").alias("n_rows"), F.sum("pressure").alias("pressure"))


def lake_layers(spark, sf_dir):
    """One table stored as a batch and as a stream by the same call, in two layers of a lake."""
    root = shared_dir(spark, "layers")
    batch, stream = lake_path(root, "cleaned", "batch"), lake_path(root, "enriched", "stream")
    write_lake(readings(spark, sf_dir), batch)
    messages = shared_dir(spark, "messages")
    publish_to_files(as_messages(raw(spark, sf_dir)), messages)
    drain(write_lake(feed(spark, messages), stream, shared_dir(spark, "stream-checkpoints"), every=None))
    both = [load_observations(spark, p).select(F.lit(layer).alias("layer"), "datetime", "city") for p, layer in ((batch, "cleaned"), (stream, "enriched"))]
    return both[0].union(both[1])


def lake_files(spark, sf_dir):
    path = shared_dir(spark, "lake")
    write_parquet(readings(spark, sf_dir), path, by_day=True)
    return load_observations(spark, path, merge_schema=True).select(*OBSERVED)


def lake_evolved(spark, sf_dir):
    """Two writes, of which only the second has measures; the schema comes from the lake's log, not from footers."""
    path = shared_dir(spark, "lake")
    df = readings(spark, sf_dir)
    append_evolving(df.filter(F.hour("datetime") < 12).select("datetime", "city"), path)
    append_evolving(df.filter(F.hour("datetime") >= 12), path)
    return load_observations(spark, path).select(*OBSERVED)


# -- enrichment and features -----------------------------------------------


def risk_score(spark, sf_dir):
    df = enrich.with_risk(readings(spark, sf_dir))
    return df.select(
        "datetime",
        "city",
        wind_score(F.col("wind_speed")).alias("wind_points"),
        temperature_score(F.col("temperature")).alias("temperature_points"),
        pressure_score(F.col("pressure")).alias("pressure_points"),
        keyword_score(F.col(CATEGORY)).alias("keyword_points"),
        "disaster_risk_score",
        "emergency_level",
    )


def risk_levels(spark, sf_dir):
    df = enrich.with_risk(readings(spark, sf_dir))
    return rounded(
        df.groupBy(emergency_level(F.col("disaster_risk_score")).alias("level")).agg(
            F.count("*").alias("n_rows"), F.avg("disaster_risk_score").alias("avg_score")
        )
    )


def comfort_indices(spark, sf_dir):
    df = enrich.with_comfort(readings(spark, sf_dir))
    return rounded(df.select("datetime", "city", "heat_index_c", "wind_chill_c", "hour", "is_daytime"))


def trend_features(spark, sf_dir):
    df = enrich.with_trend(observations(spark, sf_dir))
    return rounded(df.select("datetime", "city", "temp_lag_1", "temp_change", "pressure_rolling_avg"))


def hot_station_features(spark, sf_dir):
    """Features of two stations that hold everything, cut into short segments."""
    two = raw(spark, sf_dir, keep=("event_id", "ts", "user_id")).select(
        F.col("ts").alias("datetime"), F.concat(F.lit("half "), (F.col("user_id") % 2).cast("string")).alias("city"), "event_id", *MEASURES
    )
    df = features.build_features(two, tie=["event_id"], split=SplitConfig(rows_per_segment=500))
    return rounded(df.select("event_id", "city", "temperature_lag_1h", "temperature_lag_24h", "humidity_rolling_mean_24h", "wind_speed_rolling_max_12h"))


def calendar_features(spark, sf_dir):
    return rounded(features.with_calendar(readings(spark, sf_dir).select("datetime", "city")))


def lag_features(spark, sf_dir):
    return features.with_lags(observations(spark, sf_dir)).drop(*TARGETS)


def rolling_features(spark, sf_dir):
    return rounded(features.with_rolling(observations(spark, sf_dir)).drop(*TARGETS))


def hour_lag_features(spark, sf_dir):
    """Readings of exactly so many hours before; the series have gaps."""
    return hours.with_hour_lags(observations(spark, sf_dir), split=HOUR_SPLIT).drop(*TARGETS)


def hour_rolling_features(spark, sf_dir):
    return rounded(hours.with_hour_rolling(observations(spark, sf_dir), split=HOUR_SPLIT).drop(*TARGETS))


def derived_features(spark, sf_dir):
    df = features.with_derived(features.with_lags(observations(spark, sf_dir)))
    return rounded(
        df.select("datetime", "city", "temp_change_1h", "pressure_tendency", "heat_index", "wind_chill")
    )


def all_features(spark, sf_dir):
    return rounded(features.build_features(observations(spark, sf_dir)))


def feature_counts(spark, sf_dir):
    """Values of every model input."""
    table = features.build_features(observations(spark, sf_dir))
    names = features.feature_names(table)
    counts = table.agg(*[F.count(F.col(n)).alias(n) for n in names])
    return counts.unpivot([], names, "feature", "n_values")


def labelled_rows(spark, sf_dir):
    """Rows that each target could be trained on."""
    table = stage(readings(spark, sf_dir), "readings")
    counts = [clean.with_label(table, t).agg(F.lit(t).alias("target"), F.count("*").alias("n_rows")) for t in TARGETS]
    return reduce(DataFrame.union, counts)


def training_rows(spark, sf_dir):
    """Complete feature rows per station, after the warm-up rows fall out."""
    complete = clean.complete_rows(features.build_features(observations(spark, sf_dir)))
    return complete.groupBy("city").agg(F.count("*").alias("n_rows"), F.min("datetime").alias("first_time"))


# -- ingest ----------------------------------------------------------------


def wide_tables(spark, sf_dir):
    """One wide table per measure, a column per station, temperature in Kelvin."""
    source = raw(spark, sf_dir, STATIONS, keep=("event_id", "event_type")).withColumns(
        {"City": F.trim("City"), "temperature": F.col("temperature") + align.KELVIN_OFFSET}
    )
    tables = {}
    for measure, left_out in LEFT_OUT.items():
        kept = source.filter((F.col("event_type") != left_out) & F.col(measure).isNotNull())
        tables[measure] = (
            kept.groupBy("datetime").pivot("City", WIDE_CITIES).agg(F.min_by(measure, "event_id"))
        )
    return tables


def unpivot_align(spark, sf_dir):
    return rounded(align.align_measures(wide_tables(spark, sf_dir)))


def kelvin_convert(spark, sf_dir):
    tables = wide_tables(spark, sf_dir)
    return align.kelvin_to_celsius(align.align_measures({"temperature": tables["temperature"]}))


def fill_series(spark, sf_dir):
    return rounded(align.by_time(align.ingest_wide(wide_tables(spark, sf_dir))))


def wide_csv_ingest(spark, sf_dir):
    """Wide CSV files to the filled table: some readings are no numbers, and the file of one measure is missing."""
    folder = shared_dir(spark, "wide")
    source = raw(spark, sf_dir, STATIONS, keep=("event_id", "event_type")).withColumns(
        {"City": F.trim("City"), "temperature": F.col("temperature") + align.KELVIN_OFFSET}
    )
    for measure, left_out in LEFT_OUT.items():
        kept = source.filter((F.col("event_type") != left_out) & F.col(measure).isNotNull())
        reading = F.col(measure).cast("string")
        if measure != CATEGORY:
            reading = F.when(F.col("event_id") % 50 == 0, "n/a").otherwise(reading)
        if measure != "pressure":
            write_csv(kept.groupBy("datetime").pivot("City", WIDE_CITIES).agg(F.min_by(reading, "event_id")), f"{folder}/{measure}.csv")
    tables = read_wide_csv(spark, {m: f"{folder}/{m}.csv" for m in LEFT_OUT})
    return rounded(align.by_time(align.ingest_wide(tables)))


def sorted_lake(spark, sf_dir):
    path = shared_dir(spark, "sorted")
    write_sorted(readings(spark, sf_dir), path, ["datetime", "city"])
    return path


def sorted_export(spark, sf_dir):
    """Readings with their position in the export, which is their place by time and station."""
    return read_sorted(spark, sorted_lake(spark, sf_dir)).select("datetime", "city", F.col(POSITION).alias("position"))


def sorted_range(spark, sf_dir):
    """A day and a half of the export, from the files whose bounds meet it."""
    low, high = (F.lit(t).cast("timestamp") for t in ("2024-01-10 00:00:00", "2024-01-11 12:00:00"))
    return read_range(spark, sorted_lake(spark, sf_dir), low, high).select("datetime", "city")


def ingest_report(spark, sf_dir):
    return align.ingest_report(align.align_measures(wide_tables(spark, sf_dir)))


# -- quality ---------------------------------------------------------------


def quality_report(spark, sf_dir):
    return rounded(quality.quality_report(readings(spark, sf_dir)))


def quality_score(spark, sf_dir):
    return quality.quality_score(readings(spark, sf_dir))


def gate_outcomes(spark, sf_dir):
    """Whether the job may go on with all readings, with the first forty, and with these without measures."""
    table = stage(readings(spark, sf_dir), "readings")
    few = stage(combine.earliest_rows(table, 40), "readings")
    bare = few.withColumns({m: F.lit(None).cast("double") for m in MEASURES})
    gates = [(name, quality.quality_gate(df)) for name, df in (("all", table), ("few", few), ("bare", bare), ("short", few.drop(CATEGORY)))]
    made = [(name, g.passed, g.score, g.rows) for name, g in gates]
    return spark.createDataFrame(made, "name string, passed boolean, score double, n_rows long")


def preview_rows(spark, sf_dir):
    return quality.preview(combine.earliest_rows(readings(spark, sf_dir), 5))


def first_cities(spark, sf_dir):
    return quality.first_cities(readings(spark, sf_dir))


def city_list(spark, sf_dir):
    return quality.cities(readings(spark, sf_dir))


def data_summary(spark, sf_dir):
    return quality.data_summary(readings(spark, sf_dir))


def iqr_filter(spark, sf_dir):
    events = read_events(spark, sf_dir).select("event_id", "value")
    return without_outliers(events, "value", error=0)


def iqr_filter_sketch(spark, sf_dir):
    """The filter by a mergeable sketch, which is exact up to its 65,535 values and errs in rank beyond."""
    events = read_events(spark, sf_dir).select("event_id", "value")
    return without_outliers(events, "value", sketch=SketchConfig(65_535))


def station_fences(spark, sf_dir):
    """Quartiles and fences of every station, merged from sketches of its days."""
    daily = readings(spark, sf_dir).select("city", F.to_date("datetime").alias("day"), "temperature")
    return rounded(outliers.fences_by(daily, "temperature", by=["day"]))


def station_outliers(spark, sf_dir):
    """Readings within half an interquartile range of their own station's quartiles."""
    kept = outliers.without_outliers_by(stage(readings(spark, sf_dir), "readings"), "wind_speed", reach=0.5)
    return kept.select("datetime", "city", "wind_speed")


def impute_mean(spark, sf_dir):
    aligned = align.align_measures(wide_tables(spark, sf_dir))
    return rounded(impute(aligned, MEASURES, "mean").drop(CATEGORY))


def latest_per_city(spark, sf_dir):
    return combine.latest_per_city(readings(spark, sf_dir))


def latest_overall(spark, sf_dir):
    return combine.latest_overall(readings(spark, sf_dir))


# -- metrics ---------------------------------------------------------------


def regression_metrics(spark, sf_dir):
    return rounded(metrics.regression_metrics(scored(spark, sf_dir)))


def classification_metrics(spark, sf_dir):
    return rounded(metrics.classification_metrics(scored(spark, sf_dir)))


def all_metrics(spark, sf_dir):
    return rounded(metrics.all_metrics(stage(scored(spark, sf_dir), "scored")))


def accuracy_bands(spark, sf_dir):
    return rounded(metrics.accuracy_bands(metrics.all_metrics(scored(spark, sf_dir))))


# -- serving ---------------------------------------------------------------


def latest_predictions(spark, sf_dir):
    return serving.latest_predictions(scored(spark, sf_dir), "City 1")


def latest_predictions_all(spark, sf_dir):
    return serving.latest_predictions_all(scored(spark, sf_dir), 24)


def available_cities(spark, sf_dir):
    return serving.available_cities(scored(spark, sf_dir))


def serving_mae(spark, sf_dir):
    return rounded(serving.error_summary(served(spark, sf_dir)))


def display_table(spark, sf_dir):
    return serving.display_table(served(spark, sf_dir))


def actual_vs_predicted(spark, sf_dir):
    return serving.actual_vs_predicted(scored(spark, sf_dir))


def category_codes(spark, sf_dir):
    return combine.category_codes(scored(spark, sf_dir))


def category_series(spark, sf_dir):
    codes = ("actual_code", "predicted_code")
    series = serving.category_series(stage(scored(spark, sf_dir), "scored"))
    return series.withColumns({c: F.col(c).cast("double") for c in codes})


def last_value_forecast(df, days=7):
    """Forecast repeating the last reading, for checking the horizon without a model."""
    repeat = {f"prediction_{t}": F.col(t) for t in TARGETS}
    return forecast(df, MEASURES, lambda last: last.withColumns(repeat), days, carry=[CATEGORY])


def forecast_horizon(spark, sf_dir):
    return last_value_forecast(readings(spark, sf_dir))


def history_plus_future(spark, sf_dir):
    history = stage(scored(spark, sf_dir), "scored")
    return combine.history_plus_future(history, last_value_forecast(history.select(*OBSERVED)))


def prediction_upsert(spark, sf_dir):
    """Two writes of overlapping predictions leave one row per key, the later one."""
    path = shared_dir(spark, "predictions")
    df = stage(scored(spark, sf_dir), "scored")
    upsert_predictions(df, path)
    later = df.filter(F.hour("datetime") < 6).withColumn("prediction_temperature", F.lit(0.0))
    upsert_predictions(later, path)
    return read_predictions(spark, path).drop("created_at")


def station_state(spark, sf_dir):
    """Current-reading table whose entries were written when they were observed."""
    return as_state(readings(spark, sf_dir), written_at=F.col("datetime"), config=LIFETIME)


def current_readings(spark, sf_dir):
    now = F.lit(NOW).cast("timestamp")
    return serving.current_readings(station_state(spark, sf_dir), now, LIFETIME)


def current_reading(spark, sf_dir):
    """The reading of one station, and of the first station that reports."""
    now = F.lit(NOW).cast("timestamp")
    state = station_state(spark, sf_dir)
    first = serving.current_reading(state, None, now, LIFETIME).withColumn("asked", F.lit("first"))
    return first.unionByName(serving.current_reading(state, "City 1", now, LIFETIME).withColumn("asked", F.lit("City 1")))


def reporting_cities(spark, sf_dir):
    now = F.lit(NOW).cast("timestamp")
    return serving.reporting_cities(station_state(spark, sf_dir), now, LIFETIME)


def reading_cards(spark, sf_dir):
    return serving.reading_cards(current_readings(spark, sf_dir))


def gauge_fractions(spark, sf_dir):
    return rounded(serving.gauge_fractions(current_readings(spark, sf_dir)))


def hash_split(spark, sf_dir):
    train, test = combine.hash_split(observations(spark, sf_dir).select("datetime", "city"))
    return train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))


def time_split(spark, sf_dir):
    """The older four fifths of all readings and the newer fifth."""
    train, test = combine.time_split(stage(readings(spark, sf_dir).select("datetime", "city"), "readings"))
    return train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))


# -- streams ---------------------------------------------------------------


def repeated_messages(spark, sf_dir):
    """Every event as a message, some twice or three times, in files out of step."""
    copies = F.explode(F.sequence(F.lit(1), F.lit(1) + F.col("event_id") % 3))
    path = shared_dir(spark, "messages")
    publish_to_files(as_messages(raw(spark, sf_dir, users=USERS).withColumn("_copy", copies)), path)
    return path


def feed(spark, path):
    return clean_stream(read_message_files(spark, path))


def stream_clean_parquet(spark, sf_dir):
    """Keys in the lake; which of several readings of a key came first is open."""
    lake = shared_dir(spark, "stream-lake")
    stream = feed(spark, repeated_messages(spark, sf_dir))
    drain(start_lake_sink(stream, lake, shared_dir(spark, "stream-checkpoints"), every=None))
    return load_observations(spark, lake).select("datetime", "city")


def stream_triggers(spark, sf_dir):
    """The lake of a stream on a timer that takes two files at a time and is stopped once it has caught up."""
    messages, arrive = arrivals(spark, sf_dir, 1)
    arrive(0)
    lake, name = shared_dir(spark, "stream-lake"), f"timed_{os.path.basename(messages)}"
    stream = clean_stream(read_message_files(spark, messages, max_files_per_trigger=2))
    query = start_lake_sink(stream, lake, shared_dir(spark, "stream-checkpoints"), every="1 second", name=name)
    query.processAllAvailable()
    stop_all(spark, [name])
    return load_observations(spark, lake).select("datetime", "city")


def stream_restart(spark, sf_dir):
    """The lake after a second run over the same messages: nothing comes twice."""
    lake, checkpoint, messages = shared_dir(spark, "stream-lake"), shared_dir(spark, "stream-checkpoints"), repeated_messages(spark, sf_dir)
    for _ in range(2):
        drain(start_lake_sink(feed(spark, messages), lake, checkpoint, every=None))
    return load_observations(spark, lake).groupBy("city").agg(F.count("*").alias("n_rows"))


def stream_latest_state(spark, sf_dir):
    path = shared_dir(spark, "stream-state")
    stream = feed(spark, repeated_messages(spark, sf_dir))
    drain(start_state_sink(stream, path, shared_dir(spark, "stream-checkpoints"), every=None))
    return read_state(spark, path).select("key", "reading.datetime", "reading.city")


def arrivals(spark, sf_dir, n=3):
    """Folder of messages, and a function that adds the next of ``n`` shares of all events to it, each from all times."""
    path = shared_dir(spark, "messages")

    def arrive(share):
        publish_to_files(as_messages(raw(spark, sf_dir).filter(F.col("event_id") % n == share).repartition(4)), path)

    return path, arrive


def lake_compacted(spark, sf_dir):
    """A lake that is compacted between two runs of its stream, and restarted once more."""
    messages, arrive = arrivals(spark, sf_dir, 2)
    lake, checkpoint = shared_dir(spark, "stream-lake"), shared_dir(spark, "stream-checkpoints")
    for share in (0, 1, None):
        if share is not None:
            arrive(share)
        drain(start_lake_sink(clean_stream(read_message_files(spark, messages, max_files_per_trigger=2)), lake, checkpoint, every=None))
        if share == 0:
            compaction.compact(spark, lake)
    # Half the rows in compacted files, the other half in files that came since.
    return compaction.read_compacted(spark, lake).select("datetime", "city")


def state_snapshot(spark, sf_dir):
    """Current readings after two runs of a stream, each batch merged into a snapshot."""
    messages, arrive = arrivals(spark, sf_dir, 2)
    path, checkpoint = shared_dir(spark, "stream-state"), shared_dir(spark, "stream-checkpoints")
    for share in (0, 1):
        arrive(share)
        drain(start_snapshot_sink(feed(spark, messages), path, checkpoint, every=None))
    return read_snapshot(spark, path).select("key", "reading.datetime", "reading.city")


def late_rows(spark, sf_dir):
    """Keys of the lake and of the late table of a stream that forgets keys after a day."""
    messages, arrive = arrivals(spark, sf_dir)
    lake, late, checkpoint = (shared_dir(spark, f"stream-{name}") for name in ("lake", "late", "checkpoints"))
    for share in range(3):
        arrive(share)
        drain(start_late_aware_sink(read_message_files(spark, messages), lake, late, checkpoint, "1 day", every=None))
    return read_stored(spark, lake).union(read_stored(spark, late)).select("datetime", "city")


def live_stations(spark, sf_dir):
    """Stations whose newest reading is at most 10 hours and 40 minutes older than the newest of all, from the state store."""
    messages, arrive = arrivals(spark, sf_dir, 2)
    path, checkpoint = shared_dir(spark, "stream-changes"), shared_dir(spark, "stream-checkpoints")
    for share in (0, 1):
        arrive(share)
        drain(start_change_sink(read_message_files(spark, messages), path, checkpoint, LIFE_SECONDS, LIFE_DELAY, every=None))
    return live(read_changes(spark, path)).select("city", "datetime")


def stream_two_sinks(spark, sf_dir):
    """Rows of the lake and newest time of the state, per station, from one stream."""
    messages, lake, path = repeated_messages(spark, sf_dir), shared_dir(spark, "stream-lake"), shared_dir(spark, "stream-state")
    drain(*start_etl(read_message_files(spark, messages), lake, path, shared_dir(spark, "stream-checkpoints"), lake_every=None, state_every=None))
    rows = load_observations(spark, lake).groupBy("city").agg(F.count("*").alias("n_rows"))
    return rows.join(read_state(spark, path).select("city", "reading.datetime"), "city")


# -- models ----------------------------------------------------------------

def model_run(spark, sf_dir):
    path = shared_dir(spark, "observations")
    readings(spark, sf_dir).write.parquet(path)
    return run_on(load_observations(spark, path), BatchConfig(path))


def train_score(spark, sf_dir):
    """Test rows of every target, and whether its metrics are sound: errors not negative, shares within 0 and 1."""
    sound = F.when(F.col("target") == CATEGORY, F.col("accuracy").between(0, 1) & F.col("f1").between(0, 1)).otherwise(
        (F.col("rmse") >= F.col("mae")) & (F.col("mae") >= 0) & (F.col("r2") <= 1)
    )
    return model_run(spark, sf_dir).metrics.select("target", "sample_count", F.coalesce(sound, F.lit(False)).alias("sound"))


def forecast_7d(spark, sf_dir):
    """Keys of the forecast, and how many targets are predicted for each."""
    predicted = sum((F.col(f"prediction_{t}").isNotNull().cast("long") for t in TARGETS), F.lit(0).cast("long"))
    return model_run(spark, sf_dir).future.select("datetime", "city", predicted.alias("n_predictions"))


def saved_models_score(spark, sf_dir):
    """Rows per target that models score the same before they are saved and after they are loaded."""
    path, models = shared_dir(spark, "observations"), shared_dir(spark, "models")
    readings(spark, sf_dir).write.parquet(path)
    # A few trees are enough to be saved.
    small = ModelConfig(gbt_iterations=3, forest_trees=3)
    result = run_on(load_observations(spark, path), BatchConfig(path, models=models, model=small))
    before = result.scored.withColumnsRenamed({f"prediction_{t}": f"before_{t}" for t in TARGETS})
    both = score_with(before, load_models(models, TARGETS))
    same = [F.count_if(F.col(f"prediction_{t}").eqNullSafe(F.col(f"before_{t}"))).alias(t) for t in TARGETS]
    counts = both.agg(F.count("*").alias("n_rows"), *same)
    return counts.unpivot("n_rows", list(TARGETS), "target", "n_same")


def batch_predictions(spark, sf_dir):
    """What the whole job stores: scored test rows and seven days ahead, per station."""
    path, predictions = shared_dir(spark, "observations"), shared_dir(spark, "predictions")
    write_parquet(readings(spark, sf_dir), path)
    run_batch(spark, BatchConfig(path, predictions=predictions, model=ModelConfig(gbt_iterations=3, forest_trees=3)))
    future = F.col("temperature").isNull()
    stored = read_predictions(spark, predictions).groupBy("city")
    return stored.agg(F.count_if(~future).alias("n_scored"), F.count_if(future & F.col("prediction_temperature").isNotNull()).alias("n_future"))


def tree_stump(spark, sf_dir):
    """Best single split of every measure by hour, weekday and day, with the scores its nodes give."""
    rows = stage(features.with_calendar(readings(spark, sf_dir)).withColumn("day_of_month", F.dayofmonth("datetime")), "calendar")
    inputs, found = ["hour_of_day", "day_of_week", "day_of_month"], None
    for measure in MEASURES:
        nodes = stage(trees.nodes_of(trees.fit_stump(rows, inputs, measure), inputs), "nodes")
        root, left, right = nodes.filter("feature IS NOT NULL"), nodes.filter("node = 1"), nodes.filter("node = 2")
        scored = trees.score_by_nodes(rows.select(measure, *inputs), inputs, nodes)
        ends = [d.select("tree", F.col("rows").alias(f"{side}_rows"), F.col("prediction").alias(f"{side}_mean")) for d, side in ((left, "left"), (right, "right"))]
        errors = scored.agg(F.lit(0).alias("tree"), F.avg(F.pow(F.col(measure) - F.col("prediction"), 2)).alias("error"))
        split = root.select("tree", F.lit(measure).alias("target"), "feature", "threshold", "gain")
        row = split.join(ends[0], "tree").join(ends[1], "tree").join(errors, "tree").drop("tree")
        found = row if found is None else found.union(row)
    return rounded(found)


def flagship(spark, sf_dir):
    """Newest feature row of every station with its risk level."""
    table = features.build_features(observations(spark, sf_dir))
    return rounded(enrich.with_risk(combine.latest_per_city(table)))


QUERIES: dict[str, Query] = {
    "clean_observations": clean_observations,
    "normalize_observations": normalized_observations,
    "rejected_by_rule": rejected_by_rule,
    "rejected_rows": rejected_rows,
    "city_readings": city_readings,
    "earliest_readings": earliest_readings,
    "json_decode": json_decode,
    "restamp_publish": restamp_publish,
    "message_files": message_files,
    "csv_files": csv_files,
    "json_files": json_files,
    "lake_files": lake_files,
    "risk_score": risk_score,
    "risk_levels": risk_levels,
    "comfort_indices": comfort_indices,
    "trend_features": trend_features,
    "hot_station_features": hot_station_features,
    "calendar_features": calendar_features,
    "lag_features": lag_features,
    "rolling_features": rolling_features,
    "derived_features": derived_features,
    "all_features": all_features,
    "training_rows": training_rows,
    "unpivot_align": unpivot_align,
    "kelvin_convert": kelvin_convert,
    "fill_series": fill_series,
    "ingest_report": ingest_report,
    "quality_report": quality_report,
    "quality_score": quality_score,
    "city_list": city_list,
    "data_summary": data_summary,
    "iqr_filter": iqr_filter,
    "impute_mean": impute_mean,
    "latest_per_city": latest_per_city,
    "latest_overall": latest_overall,
    "regression_metrics": regression_metrics,
    "classification_metrics": classification_metrics,
    "all_metrics": all_metrics,
    "accuracy_bands": accuracy_bands,
    "latest_predictions": latest_predictions,
    "latest_predictions_all": latest_predictions_all,
    "available_cities": available_cities,
    "serving_mae": serving_mae,
    "display_table": display_table,
    "actual_vs_predicted": actual_vs_predicted,
    "category_codes": category_codes,
    "category_series": category_series,
    "forecast_horizon": forecast_horizon,
    "history_plus_future": history_plus_future,
    "prediction_upsert": prediction_upsert,
    "current_readings": current_readings,
    "reporting_cities": reporting_cities,
    "reading_cards": reading_cards,
    "gauge_fractions": gauge_fractions,
    "hash_split": hash_split,
    "stream_clean_parquet": stream_clean_parquet,
    "stream_latest_state": stream_latest_state,
    "stream_restart": stream_restart,
    "stream_two_sinks": stream_two_sinks,
    "current_reading": current_reading,
    "lake_evolved": lake_evolved,
    "iqr_filter_sketch": iqr_filter_sketch,
    "lake_compacted": lake_compacted,
    "state_snapshot": state_snapshot,
    "hour_lag_features": hour_lag_features,
    "hour_rolling_features": hour_rolling_features,
    "station_fences": station_fences,
    "station_outliers": station_outliers,
    "time_split": time_split,
    "late_rows": late_rows,
    "latest_features": flagship,
    "train_score": train_score,
    "forecast_7d": forecast_7d,
    "saved_models_score": saved_models_score,
    "tree_stump": tree_stump,
    "parquet_files": parquet_files,
    "source_dispatch": source_dispatch,
    "lake_layers": lake_layers,
    "gate_outcomes": gate_outcomes,
    "preview_rows": preview_rows,
    "first_cities": first_cities,
    "feature_counts": feature_counts,
    "labelled_rows": labelled_rows,
    "stream_triggers": stream_triggers,
    "batch_predictions": batch_predictions,
    "live_stations": live_stations,
    "wide_csv_ingest": wide_csv_ingest,
    "sorted_export": sorted_export,
    "sorted_range": sorted_range,
}
