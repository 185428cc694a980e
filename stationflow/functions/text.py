"""Text and type coercions; malformed input becomes null under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_timestamp(name: str, data_type: T.DataType) -> Column:
    """Text is parsed, other temporal types are converted."""
    c = F.col(name)
    if isinstance(data_type, T.StringType):
        return F.try_to_timestamp(c)
    return c.cast("timestamp")


def to_number(name: str, data_type: T.DataType) -> Column:
    c = F.col(name)
    if isinstance(data_type, T.DoubleType):
        return c
    return c.try_cast("double")


def title_words(c: Column) -> Column:
    """Trimmed, each blank-separated word capitalised."""
    return F.initcap(F.trim(c))


def tidy_lower(c: Column) -> Column:
    return F.lower(F.trim(c))


def city_of_key(key: Column) -> Column:
    """The part of a state key after its last colon."""
    return F.substring_index(key, ":", -1)
