"""Display conventions of stored observations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CATEGORY, MEASURES
from ..functions.text import tidy_lower, title_words


def normalize_observations(df: DataFrame) -> DataFrame:
    """Two decimals (half up), lower-case descriptions, capitalised stations."""
    columns = {m: F.round(m, 2) for m in MEASURES if m in df.columns}
    if CATEGORY in df.columns:
        columns[CATEGORY] = tidy_lower(F.col(CATEGORY))
    if "city" in df.columns:
        columns["city"] = title_words(F.col("city"))
    return df.withColumns(columns)
