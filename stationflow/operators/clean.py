"""Cleaning: coercion, mandatory fields, range rules, deduplication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import CATEGORY, MEASURES, RANGE_RULES, RangeRule
from ..functions.text import title_words, to_number, to_timestamp

KEYS = ("datetime", "city")
MANDATORY = ("datetime", "city", "temperature")


def coerce_types(df: DataFrame) -> DataFrame:
    """Name the station column ``city``; type time and measures, bad text -> null."""
    if "City" in df.columns:
        df = df.withColumnRenamed("City", "city")
    types = {f.name: f.dataType for f in df.schema}
    columns = {"datetime": to_timestamp("datetime", types["datetime"])}
    columns |= {m: to_number(m, types[m]) for m in MEASURES if m in types}
    return df.withColumns(columns)


def tidy_text(df: DataFrame) -> DataFrame:
    columns = {}
    if CATEGORY in df.columns:
        columns[CATEGORY] = title_words(F.col(CATEGORY))
    if "city" in df.columns:
        columns["city"] = F.trim("city")
    return df.withColumns(columns)


def has_mandatory() -> Column:
    """Time, station and a numeric temperature are all there."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in MANDATORY])
    return present & ~F.isnan("temperature")


def rule_holds(rule: RangeRule) -> Column:
    """Null when the measure is null, so a filter drops such rows."""
    tests = []
    if rule.low is not None:
        tests.append(F.col(rule.column) >= rule.low)
    if rule.high is not None:
        tests.append(F.col(rule.column) <= rule.high)
    return reduce(lambda a, b: a & b, tests)


def in_ranges(rules: Sequence[RangeRule] = RANGE_RULES) -> Column:
    return reduce(lambda a, b: a & b, [rule_holds(r) for r in rules])


def first_failed_rule(rules: Sequence[RangeRule] = RANGE_RULES) -> Column:
    """Name of the first check a coerced row fails; null for accepted rows."""
    names = [F.when(F.col(c).isNull(), f"{c}_missing") for c in MANDATORY]
    names.append(F.when(F.isnan("temperature"), "temperature_missing"))
    names += [F.when(~F.coalesce(rule_holds(r), F.lit(False)), r.name) for r in rules]
    return F.coalesce(*names)


def valid_observations(df: DataFrame, rules: Sequence[RangeRule] = RANGE_RULES) -> DataFrame:
    """Everything of the cleaning that looks at one row only (batch or stream)."""
    typed = coerce_types(df)
    return tidy_text(typed.filter(has_mandatory() & in_ranges(rules)))


def rejected_observations(df: DataFrame, rules: Sequence[RangeRule] = RANGE_RULES) -> DataFrame:
    """The rows cleaning drops, each with the first check it fails."""
    return coerce_types(df).withColumn("rule", first_failed_rule(rules)).filter("rule IS NOT NULL")


def dedupe(
    df: DataFrame, keys: Sequence[str] = KEYS, order_by: Sequence[str | Column] | None = None
) -> DataFrame:
    """One row per key: the first by ``order_by``, by default by all other columns.

    ``row_number() = 1`` lets Catalyst limit every map task to one row per key
    before the shuffle, so a key with very many copies costs no more than others.
    """
    order = list(order_by) if order_by else [c for c in df.columns if c not in keys]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def dedupe_stream(
    df: DataFrame,
    keys: Sequence[str] = KEYS,
    delay: str | None = None,
    spread: int = 1,
) -> DataFrame:
    """First arrival per key on a stream.

    By default all keys are kept for ever and no row is lost. ``delay`` bounds
    the state by a watermark on ``datetime`` and drops rows that come later.
    With ``spread`` > 1 a first pass deduplicates within (key, slice of the
    input tasks), so at most ``spread`` copies of a hot key reach the task that
    owns it, for as many more entries of state.
    """
    if delay:
        df = df.withWatermark("datetime", delay)
    if spread > 1:
        df = (
            df.withColumn("_slice", F.pmod(F.spark_partition_id(), F.lit(spread)))
            .dropDuplicates([*keys, "_slice"])
            .drop("_slice")
        )
    return df.dropDuplicates(list(keys))


def clean_observations(
    df: DataFrame,
    rules: Sequence[RangeRule] = RANGE_RULES,
    order_by: Sequence[str | Column] | None = None,
    delay: str | None = None,
    spread: int = 1,
) -> DataFrame:
    """Coerce, drop unusable rows, tidy text, apply the range rules, deduplicate."""
    valid = valid_observations(df, rules)
    if df.isStreaming:
        return dedupe_stream(valid, delay=delay, spread=spread)
    return dedupe(valid, order_by=order_by)


def for_city(df: DataFrame, city: str | None) -> DataFrame:
    """Equality on the stored column, so it reaches the Parquet scan."""
    return df if city is None else df.filter(F.col("city") == city)


def with_label(df: DataFrame, target: str) -> DataFrame:
    return df.filter(F.col(target).isNotNull())


def complete_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without null or NaN, e.g. past the warm-up rows of the features.

    The columns are tested in a loop over arrays: as one condition a column, the code that
    Spark makes of a wide table is too long for the JVM to compile and is interpreted.
    """
    kinds, tests = {f.name: f.dataType for f in df.schema}, []
    names = list(columns) if columns else df.columns
    for kind in (T.DoubleType, T.FloatType):
        numbers = [F.col(f"`{c}`") for c in names if isinstance(kinds[c], kind)]
        if numbers:
            tests.append(F.forall(F.array(*numbers), lambda v: v.isNotNull() & ~F.isnan(v)))
    others = [F.col(f"`{c}`").isNotNull() for c in names if not isinstance(kinds[c], (T.DoubleType, T.FloatType))]
    if others:
        tests.append(F.forall(F.array(*others), lambda there: there))
    return df.filter(reduce(lambda a, b: a & b, tests)) if tests else df
