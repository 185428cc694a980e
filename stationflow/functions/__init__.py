from .calendar import calendar_columns, cyclic, daytime_flag, season
from .scores import (
    emergency_level,
    heat_index,
    heat_index_c,
    keyword_score,
    pressure_score,
    pressure_tendency,
    risk_score,
    temperature_score,
    wind_chill,
    wind_chill_c,
    wind_score,
)
from .text import city_of_key, title_words, tidy_lower, to_number, to_timestamp

__all__ = [
    "calendar_columns",
    "city_of_key",
    "cyclic",
    "daytime_flag",
    "emergency_level",
    "heat_index",
    "heat_index_c",
    "keyword_score",
    "pressure_score",
    "pressure_tendency",
    "risk_score",
    "season",
    "temperature_score",
    "tidy_lower",
    "title_words",
    "to_number",
    "to_timestamp",
    "wind_chill",
    "wind_chill_c",
    "wind_score",
]
