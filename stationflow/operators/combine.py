"""Latest rows, unions, category codes, horizon expansion, upsert."""

from __future__ import annotations

import math
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import CATEGORY, TARGETS
from ..session import stage
from .outliers import exact_ranks

#: Categories of which the codes are sent to every executor.
MOST_BROADCAST_CODES = 100_000


def latest_per_city(df: DataFrame, tie: Sequence[str] = (), key: str = "city") -> DataFrame:
    """The newest row of every station; equal times are decided by ``tie``, then the whole row.

    Ranks that Catalyst limits to one row per station in the map tasks, before
    the shuffle.
    """
    others = [c for c in df.columns if c not in ("datetime", *tie)]
    order = [F.col(c).desc_nulls_last() for c in ("datetime", *tie, *others)]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def latest_overall(df: DataFrame) -> DataFrame:
    """The single newest row; equal times are decided by station name."""
    return df.orderBy(F.col("datetime").desc(), F.col("city")).limit(1)


def earliest_rows(df: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` rows in time, a top-n per task and then overall."""
    return df if n is None else df.orderBy("datetime", "city").limit(n)


def union_by_name(history: DataFrame, future: DataFrame) -> DataFrame:
    """Append rows that lack columns; the gaps are nulls of the column's own type."""
    gaps = [
        F.lit(None).cast(f.dataType).alias(f.name) for f in history.schema if f.name not in future.columns
    ]
    return history.unionByName(future.select("*", *gaps), allowMissingColumns=True)


def history_plus_future(
    history: DataFrame, future: DataFrame, targets: Sequence[str] = TARGETS
) -> DataFrame:
    """Scored history and forecast in one export table; forecast actuals are null."""
    return union_by_name(export_columns(history, targets), export_columns(future.drop(*targets), targets))


def export_columns(df: DataFrame, targets: Sequence[str] = TARGETS) -> DataFrame:
    """Key, actual and predicted columns, as far as they exist."""
    wanted = ["datetime", "city", *targets, *[f"prediction_{t}" for t in targets]]
    return df.select(*[c for c in wanted if c in df.columns])


def expand_horizon(last_rows: DataFrame, days: int = 7, keep_time: bool = False) -> DataFrame:
    """Each row once per following day 1..``days``.

    Times fall on midnight unless ``keep_time``; all other columns persist.
    """
    day = F.col("_day")
    stamp = F.col("datetime") + F.make_dt_interval(day) if keep_time else F.date_add("datetime", day).cast("timestamp")
    return (
        last_rows.withColumn("_day", F.explode(F.sequence(F.lit(1), F.lit(days))))
        .withColumn("datetime", stamp)
        .drop("_day")
    )


def dense_codes(values: DataFrame, column: str) -> DataFrame:
    """Distinct non-null texts numbered 0..n-1 in order.

    The distinct texts are range-partitioned and ranked within their range; the
    ranges are offset by a running count, so no task sorts more than one range,
    whatever beginnings the texts share.
    """
    ranges = stage(
        values.filter(F.col(column).isNotNull())
        .select(column)
        .distinct()
        .repartitionByRange(column)
        .withColumn("_range", F.spark_partition_id()),
        "codes",
    )
    sizes = ranges.groupBy("_range").agg(F.count("*").alias("_size"))
    # One row per range.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(column)) - 1
    return (
        ranges.withColumn("_rank", within)
        .join(offsets, "_range")
        .select(column, (F.col("_offset") + F.col("_rank")).cast("int").alias("code"))
    )


def category_codes(df: DataFrame, target: str = CATEGORY) -> DataFrame:
    """Codes of every category seen as actual or predicted value."""
    both = df.select(F.explode(F.array(target, f"prediction_{target}")).alias("category"))
    return dense_codes(both, "category")


def with_category_codes(df: DataFrame, target: str = CATEGORY) -> DataFrame:
    """Add ``actual_code`` and ``predicted_code``; nulls stay null.

    The codes are counted first: up to ``MOST_BROADCAST_CODES`` they go to every
    executor, and no row of ``df`` is shuffled on a column of few values.
    Beyond, there are too many categories for any to be a hot key by nature.
    """
    codes = stage(category_codes(df, target), "category-codes")
    if codes.count() <= MOST_BROADCAST_CODES:
        codes = F.broadcast(codes)
    actual = codes.select(F.col("category").alias(target), F.col("code").alias("actual_code"))
    predicted = codes.select(F.col("category").alias(f"prediction_{target}"), F.col("code").alias("predicted_code"))
    return df.join(actual, target, "left").join(predicted, f"prediction_{target}", "left")


def upsert(
    old: DataFrame, new: DataFrame, keys: Sequence[str] = ("city", "datetime")
) -> DataFrame:
    """``new`` plus the rows of ``old`` whose key it does not replace."""
    return old.join(new.select(*keys), list(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def hash_share(df: DataFrame, keys: Sequence[str]) -> Column:
    """A number in [0, 1) fixed by the key, the same on every run and layout.

    A time counts as its microseconds, so the session's time zone has no part in it.
    """
    times = {name for name, kind in df.dtypes if kind == "timestamp"}
    parts = [(F.unix_micros(k) if k in times else F.col(k)).cast("string") for k in keys]
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def hash_split(
    df: DataFrame, train_fraction: float = 0.8, keys: Sequence[str] = ("city", "datetime")
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the key: no shuffle, no dependence on layout."""
    marked = df.withColumn("_share", hash_share(df, keys))
    return (
        marked.filter(F.col("_share") < train_fraction).drop("_share"),
        marked.filter(F.col("_share") >= train_fraction).drop("_share"),
    )


def random_split(df: DataFrame, train_fraction: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    train, test = df.randomSplit([train_fraction, 1 - train_fraction], seed=seed)
    return train, test


def time_cutoff(df: DataFrame, train_fraction: float = 0.8, time: str = "datetime") -> int | None:
    """Microseconds of the newest training time: its percent rank is below the fraction, that of the next time is not.

    ``percent_rank`` of a row is the number of rows with an earlier time over ``n - 1``, so the cut is the
    value at rank ``ceil(fraction * (n - 1))``, found by histograms of bounded size; no window over the table.
    Null when there is no time, or nothing is to be trained on.
    """
    # The fraction as it is written: 0.8 means four fifths.
    share = Fraction(str(train_fraction))
    if share <= 0:
        return None
    found = exact_ranks(df.select(F.unix_micros(time).alias("t")), "t", lambda n: [max(1, math.ceil(share * (n - 1)))])
    return int(found[0]) if found else None


def time_split(df: DataFrame, train_fraction: float = 0.8, time: str = "datetime") -> tuple[DataFrame, DataFrame]:
    """Older rows to train on and newer ones to test with; equal times are never parted.

    The cut is one literal, so either part is a filter that reaches the scan. Rows without time are trained on.
    """
    micros = time_cutoff(df, train_fraction, time)
    if micros is None:
        return df.filter(F.col(time).isNull()), df.filter(F.col(time).isNotNull())
    cutoff = F.timestamp_micros(F.lit(micros))
    return df.filter(F.col(time).isNull() | (F.col(time) <= cutoff)), df.filter(F.col(time) > cutoff)
