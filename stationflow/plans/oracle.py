"""The catalog's queries as DuckDB SQL over the same tables."""

from __future__ import annotations

# Fixed values, written out here so that the SQL does not follow the code under test.
MEASURES = ("temperature", "humidity", "pressure", "wind_speed", "wind_direction")
TARGETS = (*MEASURES, "weather_desc")
USERS = 10
STATIONS = 12
NOW = "2024-01-30 23:30:00"
LIFETIME_SECONDS = 21600
LEFT_OUT = {
    "temperature": "none",
    "humidity": "view",
    "pressure": "click",
    "weather_desc": "signup",
    "wind_direction": "purchase",
    "wind_speed": "error",
}
LAGS = (1, 3, 6, 12, 24)
SIZES = (6, 12, 24)
OBSERVED = "datetime, city, " + ", ".join(TARGETS)


def r6(expression: str, name: str) -> str:
    return f"round({expression}, 6) + 0e0 AS {name}"


def raw_sql(stations: int | None = None, users: int = 1) -> str:
    number = f"user_id // {users}" if stations is None else f"user_id % {stations}"
    return f"""
      SELECT event_id, event_type,
        strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS datetime,
        '  city ' || CAST({number} AS VARCHAR) || ' ' AS "City",
        CAST(event_id * 37 % 1290 AS DOUBLE) / 10e0 - 58e0 AS temperature,
        CAST(json_extract_string(props, '$.k') AS DOUBLE) * 1.1e0 AS humidity,
        CAST(790 + event_id % 421 AS DOUBLE) AS pressure,
        CASE event_type WHEN 'click' THEN ' clear sky ' WHEN 'error' THEN 'Thunderstorm'
             WHEN 'purchase' THEN 'light RAIN' WHEN 'signup' THEN 'hurricane watch' END AS weather_desc,
        CAST(event_id * 13 % 370 AS DOUBLE) AS wind_direction,
        CAST(event_id * 7 % 125 - 3 AS DOUBLE) AS wind_speed
      FROM events"""


VALID = """temperature BETWEEN -50 AND 60 AND humidity BETWEEN 0 AND 100
        AND pressure BETWEEN 800 AND 1200 AND wind_speed >= 0 AND wind_direction BETWEEN 0 AND 360"""
RAW_FIELDS = 'datetime, "City", temperature, humidity, pressure, weather_desc, wind_direction, wind_speed'


def title(expression: str) -> str:
    words = f"string_split(lower(trim({expression})), ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || w[2:]), ' ')"


def base(users: int = 1) -> str:
    """CTEs ``raw``, ``cleaned`` and ``obs``."""
    return f"""WITH raw AS ({raw_sql(users=users)}),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY datetime, "City" ORDER BY event_id) AS rn FROM raw WHERE {VALID}),
    cleaned AS (
      SELECT event_id, CAST(datetime AS TIMESTAMP) AS datetime, trim("City") AS city, temperature, humidity,
        pressure, {title('weather_desc')} AS weather_desc, wind_direction, wind_speed
      FROM ranked WHERE rn = 1),
    obs AS (
      SELECT datetime, {title('city')} AS city, {', '.join(f'round({m}, 2) AS {m}' for m in MEASURES)},
        lower(trim(weather_desc)) AS weather_desc FROM cleaned)"""


def windowed() -> str:
    return "PARTITION BY city ORDER BY datetime"


def scored() -> str:
    lags = ", ".join(f"lag({t}) OVER w AS prediction_{t}" for t in TARGETS)
    return f"{base()}, scored AS (SELECT *, {lags} FROM obs WINDOW w AS ({windowed()}))"


# -- feature expressions -----------------------------------------------------

LAG_COLUMNS = ", ".join(f"lag({m}, {n}) OVER w AS {m}_lag_{n}h" for m in MEASURES for n in LAGS)


def rolling_columns() -> str:
    columns = []
    for m in MEASURES:
        for s in SIZES:
            frame = f"({windowed()} ROWS BETWEEN {s} PRECEDING AND CURRENT ROW)"
            columns.append(r6(f"avg({m}) OVER {frame}", f"{m}_rolling_mean_{s}h"))
            columns.append(r6(f"stddev_samp({m}) OVER {frame}", f"{m}_rolling_std_{s}h"))
            if "wind" in m:
                columns.append(r6(f"max({m}) OVER {frame}", f"{m}_rolling_max_{s}h"))
    return ", ".join(columns)


CALENDAR = ", ".join(
    [
        "CAST(hour(datetime) AS INTEGER) AS hour_of_day",
        "CAST(dayofweek(datetime) + 1 AS INTEGER) AS day_of_week",
        "CAST(month(datetime) AS INTEGER) AS month_of_year",
        """CASE WHEN month(datetime) IN (12, 1, 2) THEN 'winter' WHEN month(datetime) IN (3, 4, 5) THEN 'spring'
             WHEN month(datetime) IN (6, 7, 8) THEN 'summer' ELSE 'fall' END AS season""",
        r6("sin(hour(datetime) * 2e0 * pi() / 24e0)", "hour_sin"),
        r6("cos(hour(datetime) * 2e0 * pi() / 24e0)", "hour_cos"),
        r6("sin((month(datetime) - 1) * 2e0 * pi() / 12e0)", "month_sin"),
        r6("cos((month(datetime) - 1) * 2e0 * pi() / 12e0)", "month_cos"),
    ]
)
DERIVED = ", ".join(
    [
        r6("temperature - lag(temperature) OVER w", "temp_change_1h"),
        """CASE WHEN pressure - lag(pressure, 3) OVER w > 2 THEN 'rising'
             WHEN pressure - lag(pressure, 3) OVER w < -2 THEN 'falling' ELSE 'stable' END AS pressure_tendency""",
        r6("temperature + 0.05e0 * humidity * (temperature - 20e0)", "heat_index"),
        r6(
            "CASE WHEN temperature < 10 AND wind_speed > 5 THEN temperature - 0.4e0 * wind_speed ELSE temperature END",
            "wind_chill",
        ),
    ]
)
FEATURES = f"""SELECT {OBSERVED}, {LAG_COLUMNS}, {rolling_columns()}, {CALENDAR}, {DERIVED}
    FROM obs WINDOW w AS ({windowed()})"""

_keyword_cases = """WHEN regexp_matches(lower(weather_desc), 'hurricane|tornado') THEN 50
      WHEN regexp_matches(lower(weather_desc), 'storm|thunder') THEN 30
      WHEN regexp_matches(lower(weather_desc), 'snow|rain') THEN 15"""
POINTS = f"""
      CASE WHEN wind_speed > 100 THEN 40e0 WHEN wind_speed > 50 THEN 30e0
           WHEN wind_speed > 20 THEN 10e0 + (wind_speed - 20e0) * 0.5e0 ELSE 0e0 END AS wind_points,
      CAST(CASE WHEN temperature < -10 OR temperature > 45 THEN 30
           WHEN temperature > 35 OR temperature < 0 THEN 15 ELSE 0 END AS INTEGER) AS temperature_points,
      CAST(CASE WHEN pressure < 980 THEN 30 WHEN pressure < 1000 THEN 15 ELSE 0 END AS INTEGER) AS pressure_points,
      CAST(CASE {_keyword_cases} ELSE 0 END AS INTEGER) AS keyword_points"""


def risk(source: str) -> str:
    """Columns of ``source`` with points, score and level."""
    return f"""SELECT *, CASE WHEN disaster_risk_score >= 70 THEN 'CRITICAL' WHEN disaster_risk_score >= 40 THEN 'HIGH'
        WHEN disaster_risk_score >= 20 THEN 'MEDIUM' ELSE 'LOW' END AS emergency_level
      FROM (SELECT *, least(100e0, wind_points + temperature_points + pressure_points + keyword_points)
              AS disaster_risk_score FROM (SELECT *, {POINTS} FROM {source}))"""


# -- ingest ------------------------------------------------------------------


def aligned(bad_every: int | None = None, without: tuple[str, ...] = ()) -> str:
    """CTEs up to ``aligned``: the full outer alignment of the wide tables.

    The reading of every ``bad_every``-th event is no number; the tables in ``without`` are not there.
    """
    tables = {m: left_out for m, left_out in LEFT_OUT.items() if m not in without}
    parts = [f"WITH raw AS ({raw_sql(STATIONS)})"]
    cities = f"SELECT 'city ' || CAST(i AS VARCHAR) AS \"City\" FROM range({STATIONS}) t(i)"
    for m, left_out in tables.items():
        value = f"{m} + 273.15e0" if m == "temperature" else m
        if bad_every and m != "weather_desc":
            value = f"CASE WHEN event_id % {bad_every} <> 0 THEN {value} END"
        parts.append(
            f"""picked_{m} AS (SELECT CAST(datetime AS TIMESTAMP) AS datetime, trim("City") AS "City",
              arg_min([{value}], event_id)[1] AS {m} FROM raw
              WHERE event_type <> '{left_out}' AND {m} IS NOT NULL GROUP BY 1, 2)"""
        )
    grid = " UNION ".join(f"SELECT DISTINCT datetime FROM picked_{m}" for m in tables)
    parts.append(f"grid AS (SELECT datetime, \"City\" FROM ({grid}) CROSS JOIN ({cities}))")
    joins = " ".join(f'LEFT JOIN picked_{m} USING (datetime, "City")' for m in tables)
    parts.append(f"aligned AS (SELECT datetime, \"City\", {', '.join(tables)} FROM grid {joins})")
    return ", ".join(parts)


def filled(bad_every: int | None = None, without: tuple[str, ...] = ()) -> str:
    columns, measures = [], [m for m in LEFT_OUT if m not in without]
    for m in measures:
        value = "round(temperature - 273.15e0, 2)" if m == "temperature" else m
        columns.append(
            f"""coalesce(last_value({value} IGNORE NULLS) OVER (PARTITION BY "City" ORDER BY datetime
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                first_value({value} IGNORE NULLS) OVER (PARTITION BY "City" ORDER BY datetime
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {m}"""
        )
    inner = f"SELECT datetime, \"City\", {', '.join(columns)} FROM aligned"
    shown = ", ".join(m if m == "weather_desc" else r6(m, m) for m in measures)
    return f'{aligned(bad_every, without)} SELECT datetime, "City", {shown} FROM ({inner})'


# -- quality -----------------------------------------------------------------


def quality_rows() -> str:
    rows = []
    for t in TARGETS:
        low, high = (f"min({t})", f"max({t})") if t in MEASURES else ("CAST(NULL AS DOUBLE)",) * 2
        rows.append(
            f"""SELECT '{t}' AS feature, TRUE AS present, count(*) FILTER ({t} IS NULL) AS missing_count,
              {r6(f"count(*) FILTER ({t} IS NULL) * 100e0 / count(*)", "missing_pct")},
              {low} AS min_value, {high} AS max_value FROM obs"""
        )
    return f"{base()} " + " UNION ALL ".join(rows)


def quality_sql(source: str, absent: int = 0) -> str:
    """Score of a table; ``absent`` of its columns are not there (null in ``source``)."""
    return f"""SELECT n AS total_records,
      CAST(floor((epoch(hi) - epoch(lo)) / 86400e0) AS INTEGER) AS time_span_days,
      CASE WHEN n = 0 THEN 0e0 ELSE 100e0
        {' '.join(f'- CASE WHEN missing_{t} * 100e0 / n > 20 THEN 5e0 ELSE 0e0 END' for t in TARGETS)}
        - {15 * absent}e0
        - CASE WHEN floor((epoch(hi) - epoch(lo)) / 86400e0) < 1 THEN 15e0 ELSE 0e0 END
        - CASE WHEN n < 50 THEN 30e0 ELSE 0e0 END END AS quality_score
      FROM (SELECT count(*) AS n, min(datetime) AS lo, max(datetime) AS hi,
        {', '.join(f'count(*) FILTER ({t} IS NULL) AS missing_{t}' for t in TARGETS)} FROM {source})"""


QUALITY_SCORE = f"""{base()}, result AS ({quality_sql('obs')})
    SELECT *, CASE WHEN quality_score >= 80 THEN 'GOOD' WHEN quality_score >= 60 THEN 'ACCEPTABLE' ELSE 'POOR' END AS band
    FROM result"""
_NO_MEASURES = ", ".join(f"CAST(NULL AS DOUBLE) AS {m}" for m in MEASURES)
GATES = f"""{base()}, few AS (SELECT * FROM obs ORDER BY datetime, city LIMIT 40),
    bare AS (SELECT datetime, city, {_NO_MEASURES}, weather_desc FROM few), short AS (SELECT * REPLACE (CAST(NULL AS VARCHAR) AS weather_desc) FROM few),
    scores AS (SELECT 'all' AS name, * FROM ({quality_sql('obs')}) UNION ALL SELECT 'few', * FROM ({quality_sql('few')})
      UNION ALL SELECT 'bare', * FROM ({quality_sql('bare')}) UNION ALL SELECT 'short', * FROM ({quality_sql('short', 1)}))
    SELECT name, quality_score >= 50 AS passed, quality_score AS score, total_records AS n_rows FROM scores"""

IQR = """WITH q AS (SELECT quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3 FROM events)
    SELECT event_id, value FROM events, q
    WHERE value >= q1 - 1.5e0 * (q3 - q1) AND value <= q3 + 1.5e0 * (q3 - q1)"""


# -- metrics -----------------------------------------------------------------


def regression() -> str:
    rows = []
    for m in MEASURES:
        p, e = f"prediction_{m}", f"({m} - prediction_{m})"
        rows.append(
            f"""SELECT '{m}' AS target,
              {r6(f"sqrt(avg({e} * {e}))", "rmse")}, {r6(f"avg(abs({e}))", "mae")},
              {r6(f"1e0 - sum({e} * {e}) / (sum(({m} - mean_{m}) * ({m} - mean_{m})))", "r2")},
              {r6(f"avg(abs({e} / (abs({m}) + 0.001e0))) * 100e0", "mape")},
              count(*) AS sample_count
            FROM (SELECT *, avg({m}) OVER () AS mean_{m} FROM scored WHERE {m} IS NOT NULL AND {p} IS NOT NULL)"""
        )
    return " UNION ALL ".join(rows)


CLASS_CTES = """pairs AS (SELECT weather_desc AS a, prediction_weather_desc AS p FROM scored
      WHERE weather_desc IS NOT NULL AND prediction_weather_desc IS NOT NULL),
    labels_seen AS (SELECT DISTINCT a AS label FROM pairs),
    per_class AS (SELECT label,
      (SELECT count(*) FROM pairs WHERE a = label) AS support,
      (SELECT count(*) FROM pairs WHERE p = label) AS claimed,
      (SELECT count(*) FROM pairs WHERE a = label AND p = label) AS hits FROM labels_seen)"""
CLASSIFICATION = f"""SELECT 'weather_desc' AS target,
      {r6("sum(hits) * 1e0 / sum(support)", "accuracy")},
      {r6("sum(support * 2e0 * hits / (support + claimed)) / sum(support)", "f1")},
      {r6('sum(support * CASE WHEN claimed = 0 THEN 0e0 ELSE hits * 1e0 / claimed END) / sum(support)', '"precision"')},
      {r6("sum(support * (hits * 1e0 / support)) / sum(support)", "recall")},
      CAST(sum(support) AS BIGINT) AS sample_count
    FROM per_class"""
ALL_METRICS = f"""SELECT target, rmse, mae, r2, mape, CAST(NULL AS DOUBLE) AS accuracy, CAST(NULL AS DOUBLE) AS f1,
      CAST(NULL AS DOUBLE) AS "precision", CAST(NULL AS DOUBLE) AS recall, sample_count FROM ({regression()})
    UNION ALL SELECT target, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE),
      accuracy, f1, "precision", recall, sample_count FROM ({CLASSIFICATION})"""


# -- features by hours -------------------------------------------------------


def hour_frame(hours: int, until: int = 0) -> str:
    return f"(PARTITION BY city ORDER BY datetime RANGE BETWEEN INTERVAL '{hours}' HOUR PRECEDING AND INTERVAL '{until}' HOUR PRECEDING)"


HOUR_LAGS = ", ".join(f"max({m}) OVER {hour_frame(n, n)} AS {m}_hour_lag_{n}" for m in MEASURES for n in LAGS)


def hour_rolling_columns() -> str:
    columns = []
    for m in MEASURES:
        for s in SIZES:
            columns.append(r6(f"avg({m}) OVER {hour_frame(s)}", f"{m}_hour_mean_{s}"))
            columns.append(r6(f"stddev_samp({m}) OVER {hour_frame(s)}", f"{m}_hour_std_{s}"))
            columns.append(f"count({m}) OVER {hour_frame(s)} AS {m}_hour_count_{s}")
            if "wind" in m:
                columns.append(r6(f"max({m}) OVER {hour_frame(s)}", f"{m}_hour_max_{s}"))
    return ", ".join(columns)


# -- serving -----------------------------------------------------------------

VIEW = """datetime, city, temperature AS temp_celsius, humidity AS humidity_pct, wind_speed AS wind_speed_kmh,
      wind_direction, prediction_temperature AS prediction_temp_celsius, prediction_humidity AS prediction_humidity_pct,
      prediction_wind_speed AS prediction_wind_speed_kmh, prediction_wind_direction,
      prediction_weather_desc AS prediction_weather_condition"""
CODES = """codes AS (SELECT category, CAST(row_number() OVER (ORDER BY category) - 1 AS INTEGER) AS code
      FROM (SELECT weather_desc AS category FROM scored WHERE weather_desc IS NOT NULL
            UNION SELECT prediction_weather_desc FROM scored WHERE prediction_weather_desc IS NOT NULL))"""
LATEST = f"""latest AS (SELECT {OBSERVED} FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY datetime DESC)
      AS rn FROM obs) WHERE rn = 1)"""
LIVE = f"""{base()}, {LATEST}, live AS (SELECT 'weather:current:' || city AS key, {OBSERVED} FROM latest
      WHERE datetime > TIMESTAMP '{NOW}' - INTERVAL '{LIFETIME_SECONDS}' SECOND)"""
FUTURE = f"""future AS (SELECT CAST(CAST(datetime AS DATE) + CAST(d AS INTEGER) AS TIMESTAMP) AS datetime, city,
      {', '.join(f'{t} AS prediction_{t}' for t in TARGETS)} FROM latest, range(1, 8) t(d))"""
PREDICTIONS = ", ".join(f"prediction_{t}" for t in TARGETS)


def typed_null(target: str) -> str:
    return f"CAST(NULL AS {'VARCHAR' if target == 'weather_desc' else 'DOUBLE'}) AS {target}"


# -- models ------------------------------------------------------------------

TEST_ROWS = f"""{base()}, numbered AS (SELECT *, row_number() OVER ({windowed()}) AS rn FROM obs),
    test AS (SELECT * FROM numbered WHERE rn > 24 AND weather_desc IS NOT NULL AND CAST('0x' || substr(md5(city || '|' ||
      CAST(epoch_us(datetime) AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296e0 >= 0.8e0),
    targets AS (SELECT unnest([{', '.join(f"'{t}'" for t in TARGETS)}]) AS target)"""
STUMP_INPUTS = {"hour_of_day": "hour(datetime)", "day_of_week": "dayofweek(datetime) + 1", "day_of_month": "day(datetime)"}


def stump() -> str:
    """Every split of every input between neighbouring values, and the one that lowers the variance most."""
    cells = " UNION ALL ".join(
        f"SELECT '{m}' AS target, '{name}' AS feature, CAST({value} AS DOUBLE) AS v, {m} AS y FROM obs" for m in MEASURES for name, value in STUMP_INPUTS.items()
    )
    return f"""{base()}, cells AS ({cells}),
      sums AS (SELECT target, feature, v, count(*) AS n, sum(y) AS s, sum(y * y) AS q FROM cells GROUP BY ALL),
      cuts AS (SELECT target, feature, (v + lead(v) OVER o) / 2e0 AS threshold,
          sum(n) OVER (o ROWS UNBOUNDED PRECEDING) AS ln, sum(s) OVER (o ROWS UNBOUNDED PRECEDING) AS ls,
          sum(n) OVER a AS n, sum(s) OVER a AS s, sum(q) OVER a AS q
        FROM sums WINDOW o AS (PARTITION BY target, feature ORDER BY v), a AS (PARTITION BY target, feature)),
      gains AS (SELECT *, (ls * ls / ln + (s - ls) * (s - ls) / (n - ln) - s * s / n) / n AS gain FROM cuts WHERE threshold IS NOT NULL),
      best AS (SELECT * FROM gains QUALIFY row_number() OVER (PARTITION BY target ORDER BY gain DESC) = 1)
      SELECT target, feature, {r6('threshold', 'threshold')}, {r6('gain', 'gain')}, CAST(ln AS BIGINT) AS left_rows, {r6('ls / ln', 'left_mean')},
        CAST(n - ln AS BIGINT) AS right_rows, {r6('(s - ls) / (n - ln)', 'right_mean')},
        {r6('q / n - (s / n) * (s / n) - gain', 'error')} FROM best"""


SQL: dict[str, str] = {
    "clean_observations": f"{base(USERS)} SELECT * FROM cleaned",
    "normalize_observations": f"{base(USERS)} SELECT {OBSERVED} FROM obs",
    "rejected_by_rule": f"""WITH raw AS ({raw_sql(users=USERS)}), marked AS (
        SELECT CASE WHEN NOT temperature BETWEEN -50 AND 60 THEN 'temperature_range'
          WHEN NOT humidity BETWEEN 0 AND 100 THEN 'humidity_range'
          WHEN NOT pressure BETWEEN 800 AND 1200 THEN 'pressure_range'
          WHEN NOT wind_speed >= 0 THEN 'wind_speed_range'
          WHEN NOT wind_direction BETWEEN 0 AND 360 THEN 'wind_direction_range' END AS rule FROM raw)
      SELECT rule, count(*) AS n_rows FROM marked WHERE rule IS NOT NULL GROUP BY rule""",
    "rejected_rows": f"""WITH raw AS ({raw_sql()}), marked AS (
        SELECT event_id, CASE WHEN NOT temperature BETWEEN -50 AND 60 THEN 'temperature_range'
          WHEN NOT humidity BETWEEN 0 AND 100 THEN 'humidity_range'
          WHEN NOT pressure BETWEEN 800 AND 1200 THEN 'pressure_range'
          WHEN NOT wind_speed >= 0 THEN 'wind_speed_range'
          WHEN NOT wind_direction BETWEEN 0 AND 360 THEN 'wind_direction_range' END AS rule FROM raw)
      SELECT event_id, rule FROM marked WHERE rule IS NOT NULL""",
    "city_readings": f"{base()} SELECT {OBSERVED} FROM obs WHERE city = 'City 1'",
    "earliest_readings": f"{base()} SELECT {OBSERVED} FROM obs ORDER BY datetime, city LIMIT 100",
    "json_decode": f"""WITH raw AS ({raw_sql()}), decoded AS (
        SELECT CASE WHEN event_type <> 'error' THEN datetime END AS datetime,
          CASE WHEN event_type NOT IN ('error', 'view') THEN "City" END AS "City",
          CASE WHEN event_type NOT IN ('error', 'signup') THEN temperature END AS temperature,
          {', '.join(f"CASE WHEN event_type <> 'error' THEN {c} END AS {c}" for c in
                     ('humidity', 'pressure', 'weather_desc', 'wind_direction', 'wind_speed'))} FROM raw)
      SELECT {RAW_FIELDS}, count(*) AS n FROM decoded GROUP BY ALL""",
    "restamp_publish": f"""WITH raw AS ({raw_sql()})
      SELECT "City" AS key, '{{"datetime":"' || strftime(CAST(datetime AS TIMESTAMP) + INTERVAL 36 HOUR, '%Y-%m-%d %H:%M:%S')
        || '","City":"' || "City" || '","temperature":' || CAST(temperature AS VARCHAR)
        || ',"humidity":' || CAST(humidity AS VARCHAR) || ',"pressure":' || CAST(pressure AS VARCHAR)
        || ',"weather_desc":' || coalesce('"' || weather_desc || '"', 'null')
        || ',"wind_direction":' || CAST(wind_direction AS VARCHAR)
        || ',"wind_speed":' || CAST(wind_speed AS VARCHAR) || '}}' AS value FROM raw""",
    "message_files": f"WITH raw AS ({raw_sql()}) SELECT {RAW_FIELDS} FROM raw",
    "csv_files": f"WITH raw AS ({raw_sql()}) SELECT {RAW_FIELDS} FROM raw",
    "json_files": f"WITH raw AS ({raw_sql()}) SELECT {RAW_FIELDS} FROM raw",
    "lake_files": f"{base()} SELECT {OBSERVED} FROM obs",
    "risk_score": f"""{base()} SELECT datetime, city, wind_points, temperature_points, pressure_points, keyword_points,
        disaster_risk_score, emergency_level FROM ({risk('obs')})""",
    "risk_levels": f"""{base()} SELECT emergency_level AS level, count(*) AS n_rows,
        {r6('avg(disaster_risk_score)', 'avg_score')} FROM ({risk('obs')}) GROUP BY 1""",
    "comfort_indices": f"""{base()} SELECT datetime, city,
        {r6('''CASE WHEN temperature >= 25
          THEN temperature + 0.55e0 * (1e0 - 0.01e0 * humidity) * (temperature - 14.5e0) ELSE temperature END''', 'heat_index_c')},
        {r6('''CASE WHEN temperature <= 10 AND wind_speed > 5
          THEN 13.12e0 + 0.6215e0 * temperature - 11.37e0 * pow(wind_speed, 0.16e0)
             + 0.3965e0 * temperature * pow(wind_speed, 0.16e0) ELSE temperature END''', 'wind_chill_c')},
        CAST(hour(datetime) AS INTEGER) AS hour,
        CAST(CASE WHEN hour(datetime) BETWEEN 6 AND 18 THEN 1 ELSE 0 END AS INTEGER) AS is_daytime FROM obs""",
    "trend_features": f"""{base()} SELECT datetime, city, {r6('lag(temperature) OVER w', 'temp_lag_1')},
        {r6('temperature - lag(temperature) OVER w', 'temp_change')},
        {r6('avg(pressure) OVER (PARTITION BY city ORDER BY datetime ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)',
            'pressure_rolling_avg')} FROM obs WINDOW w AS ({windowed()})""",
    "calendar_features": f"{base()} SELECT datetime, city, {CALENDAR} FROM obs",
    "hot_station_features": f"""WITH raw AS ({raw_sql()}), two AS (
        SELECT event_id, temperature, humidity, raw.wind_speed, e.ts, 'half ' || CAST(e.user_id % 2 AS VARCHAR) AS city FROM raw JOIN events e USING (event_id))
      SELECT event_id, city, round(lag(temperature, 1) OVER w, 6) + 0e0 AS temperature_lag_1h,
        round(lag(temperature, 24) OVER w, 6) + 0e0 AS temperature_lag_24h,
        round(avg(humidity) OVER (PARTITION BY city ORDER BY ts, event_id ROWS 24 PRECEDING), 6) + 0e0 AS humidity_rolling_mean_24h,
        max(wind_speed) OVER (PARTITION BY city ORDER BY ts, event_id ROWS 12 PRECEDING) AS wind_speed_rolling_max_12h
      FROM two WINDOW w AS (PARTITION BY city ORDER BY ts, event_id)""",
    "lag_features": f"{base()} SELECT datetime, city, {LAG_COLUMNS} FROM obs WINDOW w AS ({windowed()})",
    "rolling_features": f"{base()} SELECT datetime, city, {rolling_columns()} FROM obs",
    "derived_features": f"{base()} SELECT datetime, city, {DERIVED} FROM obs WINDOW w AS ({windowed()})",
    "all_features": f"{base()} {FEATURES}",
    "training_rows": f"""{base()}, numbered AS (SELECT *, row_number() OVER ({windowed()}) AS rn FROM obs)
      SELECT city, count(*) AS n_rows, min(datetime) AS first_time FROM numbered
      WHERE rn > 24 AND weather_desc IS NOT NULL GROUP BY city""",
    "unpivot_align": f"""{aligned()} SELECT datetime, "City",
        {', '.join(m if m == 'weather_desc' else r6(m, m) for m in LEFT_OUT)} FROM aligned""",
    "kelvin_convert": f"""{aligned()}, hours AS (SELECT DISTINCT datetime FROM picked_temperature)
      SELECT datetime, "City", round(temperature - 273.15e0, 2) AS temperature FROM aligned JOIN hours USING (datetime)""",
    "fill_series": filled(),
    "wide_csv_ingest": filled(50, ("pressure",)),
    "sorted_export": f"""{base()} SELECT datetime, city, CAST(row_number() OVER (ORDER BY datetime, city) - 1 AS BIGINT) AS position FROM obs""",
    "sorted_range": f"""{base()} SELECT datetime, city FROM obs WHERE datetime BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-11 12:00:00'""",
    "ingest_report": f'{aligned()} SELECT count(*) AS n_rows, count(DISTINCT "City") AS n_cities FROM aligned',
    "quality_report": quality_rows(),
    "quality_score": QUALITY_SCORE,
    "city_list": f"{base()} SELECT DISTINCT city FROM obs",
    "data_summary": f"""{base()} SELECT count(*) AS total_records, CAST(8 AS INTEGER) AS total_columns,
        count(DISTINCT city) AS n_cities FROM obs""",
    "iqr_filter": IQR,
    "impute_mean": f"""{aligned()} SELECT datetime, "City",
        {', '.join(r6(f'coalesce({m}, (SELECT avg({m}) FROM aligned))', m) for m in MEASURES)} FROM aligned""",
    "latest_per_city": f"{base()}, {LATEST} SELECT * FROM latest",
    "latest_overall": f"{base()} SELECT {OBSERVED} FROM obs ORDER BY datetime DESC, city LIMIT 1",
    "regression_metrics": f"{scored()} {regression()}",
    "classification_metrics": f"{scored()}, {CLASS_CTES} {CLASSIFICATION}",
    "all_metrics": f"{scored()}, {CLASS_CTES} {ALL_METRICS}",
    "accuracy_bands": f"""{scored()} SELECT target, r2,
        CASE WHEN r2 >= 0.8 THEN 'good' WHEN r2 >= 0.5 THEN 'fair' ELSE 'poor' END AS band FROM ({regression()})""",
    "latest_predictions": f"{scored()} SELECT {VIEW} FROM scored WHERE city = 'City 1' ORDER BY datetime DESC LIMIT 336",
    "latest_predictions_all": f"""{scored()} SELECT {VIEW} FROM (SELECT *, row_number() OVER
        (PARTITION BY city ORDER BY datetime DESC) AS rn FROM scored) WHERE rn <= 24""",
    "available_cities": f"{base()} SELECT DISTINCT city FROM obs",
    "serving_mae": f"""{scored()} SELECT {r6('avg(abs(temperature - prediction_temperature))', 'mae_temp_celsius')},
        {r6('avg(abs(humidity - prediction_humidity))', 'mae_humidity_pct')},
        {r6('avg(abs(wind_speed - prediction_wind_speed))', 'mae_wind_speed_kmh')},
        {r6('avg(abs(wind_direction - prediction_wind_direction))', 'mae_wind_direction')} FROM scored""",
    "display_table": f"""{scored()} SELECT strftime(datetime, '%Y-%m-%d %H:%M') AS "Time",
        prediction_weather_desc AS "Condition", prediction_temperature AS "Temp (°C)", prediction_humidity AS "Humidity (%)",
        prediction_wind_speed AS "Wind Spd (km/h)", prediction_wind_direction AS "Wind Dir (°)" FROM scored""",
    "actual_vs_predicted": f"{scored()} "
    + " UNION ALL ".join(
        f"SELECT city, '{m}' AS target, datetime, {m} AS actual, prediction_{m} AS predicted FROM scored" for m in MEASURES
    ),
    "category_codes": f"{scored()}, {CODES} SELECT * FROM codes",
    "category_series": f"""{scored()}, {CODES} SELECT city, datetime, CAST(a.code AS DOUBLE) AS actual_code, CAST(p.code AS DOUBLE) AS predicted_code
      FROM scored LEFT JOIN codes a ON weather_desc = a.category LEFT JOIN codes p ON prediction_weather_desc = p.category""",
    "forecast_horizon": f"{base()}, {LATEST}, {FUTURE} SELECT * FROM future",
    "history_plus_future": f"""{scored()}, {LATEST}, {FUTURE}
      SELECT {OBSERVED}, {PREDICTIONS} FROM scored UNION ALL
      SELECT datetime, city, {', '.join(typed_null(t) for t in TARGETS)}, {PREDICTIONS} FROM future""",
    "prediction_upsert": f"""{scored()} SELECT {OBSERVED},
        CASE WHEN hour(datetime) < 6 THEN 0e0 ELSE prediction_temperature END AS prediction_temperature,
        {', '.join(f'prediction_{t}' for t in TARGETS if t != 'temperature')} FROM scored""",
    "current_readings": f"{LIVE} SELECT * FROM live",
    "reporting_cities": f"{LIVE} SELECT city FROM live",
    "reading_cards": f"""{LIVE} SELECT city, printf('%.1f°C', temperature) AS temperature,
        CAST(CAST(round(humidity) AS BIGINT) AS VARCHAR) || '%' AS humidity,
        CAST(CAST(round(pressure) AS BIGINT) AS VARCHAR) || ' hPa' AS pressure,
        {title("coalesce(weather_desc, 'unknown')")} AS condition,
        printf('%.1f km/h', wind_speed) AS wind_speed,
        CAST(CAST(round(wind_direction) AS BIGINT) AS VARCHAR) || '°' AS wind_direction,
        strftime(datetime, '%H:%M:%S') AS last_update FROM live""",
    "gauge_fractions": f"""{LIVE} SELECT city, {r6('temperature / 50e0', 'temperature_fraction')},
        {r6('humidity / 100e0', 'humidity_fraction')}, {r6('wind_speed / 100e0', 'wind_speed_fraction')} FROM live""",
    "hash_split": f"""{base()} SELECT datetime, city, CASE WHEN CAST('0x' || substr(md5(city || '|' ||
        CAST(epoch_us(datetime) AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296e0 < 0.8e0 THEN 'train' ELSE 'test' END AS part
      FROM obs""",
    "stream_clean_parquet": f"{base(USERS)} SELECT datetime, city FROM obs",
    "stream_latest_state": f"{base(USERS)}, {LATEST} SELECT 'weather:current:' || city AS key, datetime, city FROM latest",
    "stream_restart": f"{base(USERS)} SELECT city, count(*) AS n_rows FROM obs GROUP BY city",
    "stream_two_sinks": f"{base(USERS)} SELECT city, count(*) AS n_rows, max(datetime) AS datetime FROM obs GROUP BY city",
    "current_reading": f"""{LIVE} SELECT *, 'first' AS asked FROM (SELECT * FROM live ORDER BY key LIMIT 1)
      UNION ALL SELECT *, 'City 1' AS asked FROM live WHERE city = 'City 1'""",
    "lake_evolved": f"""{base()} SELECT datetime, city,
        {', '.join(f'CASE WHEN hour(datetime) >= 12 THEN {t} END AS {t}' for t in TARGETS)} FROM obs""",
    "iqr_filter_sketch": IQR,
    "lake_compacted": f"{base()} SELECT datetime, city FROM obs",
    "late_rows": f"{base()} SELECT datetime, city FROM obs",
    "state_snapshot": f"{base()}, {LATEST} SELECT 'weather:current:' || city AS key, datetime, city FROM latest",
    "live_stations": f"""{base()}, {LATEST} SELECT city, datetime FROM latest
      WHERE datetime + INTERVAL '1800' SECOND > (SELECT max(datetime) FROM obs) - INTERVAL '610' MINUTE""",
    "hour_lag_features": f"{base()} SELECT datetime, city, {HOUR_LAGS} FROM obs",
    "hour_rolling_features": f"{base()} SELECT datetime, city, {hour_rolling_columns()} FROM obs",
    "station_fences": f"""{base()}, q AS (SELECT city, count(*) AS n, quantile_disc(temperature, 0.25) AS q1,
        quantile_disc(temperature, 0.75) AS q3 FROM obs GROUP BY city)
      SELECT city, n, {r6('q1', 'q1')}, {r6('q3', 'q3')}, {r6('q1 - 1.5e0 * (q3 - q1)', 'low')}, {r6('q3 + 1.5e0 * (q3 - q1)', 'high')} FROM q""",
    "station_outliers": f"""{base()}, q AS (SELECT city, quantile_disc(wind_speed, 0.25) AS q1, quantile_disc(wind_speed, 0.75) AS q3
        FROM obs GROUP BY city)
      SELECT datetime, city, wind_speed FROM obs JOIN q USING (city)
      WHERE wind_speed BETWEEN q1 - 0.5e0 * (q3 - q1) AND q3 + 0.5e0 * (q3 - q1)""",
    "time_split": f"""{base()} SELECT datetime, city,
        CASE WHEN percent_rank() OVER (ORDER BY datetime) < 0.8 THEN 'train' ELSE 'test' END AS part FROM obs""",
    "train_score": f"""{TEST_ROWS} SELECT target, (SELECT count(*) FROM test) AS sample_count, TRUE AS sound FROM targets""",
    "forecast_7d": f"""{base()}, numbered AS (SELECT *, row_number() OVER ({windowed()}) AS rn FROM obs),
      newest AS (SELECT city, max(datetime) AS datetime FROM numbered WHERE rn > 24 GROUP BY city)
      SELECT CAST(CAST(datetime AS DATE) + CAST(d AS INTEGER) AS TIMESTAMP) AS datetime, city, CAST(6 AS BIGINT) AS n_predictions
      FROM newest, range(1, 8) t(d)""",
    "saved_models_score": f"""{TEST_ROWS} SELECT (SELECT count(*) FROM test) AS n_rows, target, (SELECT count(*) FROM test) AS n_same FROM targets""",
    "tree_stump": stump(),
    "parquet_files": f"WITH raw AS ({raw_sql()}) SELECT {RAW_FIELDS} FROM raw",
    "source_dispatch": f"""WITH raw AS ({raw_sql()}) SELECT source, "City", count(*) AS n_rows, sum(pressure) AS pressure
      FROM raw, (SELECT unnest(['file', 'messages']) AS source) GROUP BY ALL""",
    "lake_layers": f"""{base()} SELECT layer, datetime, city FROM obs, (SELECT unnest(['cleaned', 'enriched']) AS layer)""",
    "gate_outcomes": GATES,
    "preview_rows": f"{base()} SELECT {OBSERVED} FROM obs ORDER BY datetime, city LIMIT 5",
    "first_cities": f"{base()} SELECT DISTINCT city FROM obs ORDER BY city LIMIT 5",
    "feature_counts": f"""{base()}, features AS ({FEATURES}),
      counts AS (SELECT COUNT(COLUMNS(* EXCLUDE (datetime, city, {', '.join(TARGETS)}, season, pressure_tendency))) FROM features)
      UNPIVOT counts ON COLUMNS(*) INTO NAME feature VALUE n_values""",
    "labelled_rows": f"{base()} " + " UNION ALL ".join(f"SELECT '{t}' AS target, count({t}) AS n_rows FROM obs" for t in TARGETS),
    "stream_triggers": f"{base()} SELECT datetime, city FROM obs",
    "batch_predictions": f"""{TEST_ROWS}, newest AS (SELECT city FROM numbered WHERE rn > 24 GROUP BY city)
      SELECT city, coalesce(n, 0) AS n_scored, CAST(7 AS BIGINT) AS n_future FROM newest LEFT JOIN (SELECT city, count(*) AS n FROM test GROUP BY city) USING (city)""",
    "latest_features": f"""{base()}, features AS ({FEATURES}), newest AS (SELECT * FROM features
        QUALIFY row_number() OVER (PARTITION BY city ORDER BY datetime DESC) = 1)
      SELECT * EXCLUDE (wind_points, temperature_points, pressure_points, keyword_points) FROM ({risk('newest')})""",
}
