"""DuckDB SQL giving the expected result of each registered query.

Written against the given tables directly: the SQL derives the same hourly readings
and states every result in one statement, without layers or files in between.
"""

from __future__ import annotations

from isobar.plans.hourly import QUESTIONS
from isobar.schemas import REQUIRED_KEYS

_FEED = ("temperature_2m", "relative_humidity_2m", "precipitation", "wind_speed_10m")
_GOLD = "temp_celsius, humidity_percent, precipitation_mm, wind_speed_kmh"

EVENT_SAMPLES = """
ev_samples AS (
  SELECT event_id AS sample, CAST(ts AS DATE) AS date_value, CAST(EXTRACT(HOUR FROM ts) AS INTEGER) AS hour,
    'user_' || CAST(user_id AS VARCHAR) AS location,
    (user_id % 180) / 2e0 AS latitude, -CAST(user_id % 360 AS DOUBLE) / 2e0 AS longitude,
    CASE WHEN event_id % 97 <> 0 THEN ((CAST(ROUND(value * 100) AS BIGINT) % 500 - 100) * 10000 + event_id % 7) / 1e5 END AS temperature_2m,
    CAST(30 + event_id % 70 AS INTEGER) AS relative_humidity_2m,
    CASE WHEN event_id % 101 <> 0
      THEN CASE WHEN event_id % 3 = 0 THEN (event_id % 50) / 1e1 ELSE 0e0 END END AS precipitation,
    ((user_id * 7 + event_id) % 350) / 1e1 AS wind_speed_10m
  FROM events)"""

LINE_SAMPLES = """
li_samples AS (
  SELECT l_orderkey * 100 + l_linenumber AS sample, CAST(l_shipdate AS DATE) AS date_value, CAST(l_orderkey % 24 AS INTEGER) AS hour,
    'loc_' || CAST(l_suppkey AS VARCHAR) AS location,
    CAST(l_suppkey % 90 AS DOUBLE) AS latitude, CAST(l_suppkey % 180 AS DOUBLE) AS longitude,
    CASE WHEN l_partkey % 97 <> 0
      THEN ((CAST(ROUND(l_extendedprice * 100) AS BIGINT) % 500 - 100) * 10000 + l_partkey % 7) / 1e5 END AS temperature_2m,
    CAST(30 + l_partkey % 70 AS INTEGER) AS relative_humidity_2m,
    CASE WHEN l_partkey % 101 <> 0
      THEN CASE WHEN l_linenumber % 3 = 0 THEN ((l_partkey % 50) * 10000 + l_partkey % 3) / 1e5 ELSE 0e0 END END AS precipitation,
    CAST(ROUND(l_quantity * 10) AS BIGINT) % 350 / 1e1 AS wind_speed_10m
  FROM lineitem)"""


def _readings(name: str, samples: str, last: str = "DESC", run_date: str = "date_value") -> str:
    return f"""
{name} AS (
  SELECT date_value, {run_date} AS run_date, hour, location, latitude, longitude, {", ".join(_FEED)},
    CAST(date_value AS TIMESTAMP) + TO_HOURS(hour) AS time
  FROM {samples}
  QUALIFY ROW_NUMBER() OVER (PARTITION BY date_value, hour, location ORDER BY sample {last}) = 1)"""


# Documents cover a week each, so folders stay few while they grow with the table.
EV = EVENT_SAMPLES + "," + _readings("ev", "ev_samples", run_date="CAST(DATE_TRUNC('week', date_value) AS DATE)")
LI = LINE_SAMPLES + "," + _readings("li", "li_samples")

_DATE_ID = "CAST(YEAR({d}) * 10000 + MONTH({d}) * 100 + DAY({d}) AS INTEGER)".replace("{d}", "date_value")

DIMS = f"""
dates AS (
  SELECT {_DATE_ID} AS date_id, date_value, CAST(YEAR(date_value) AS INTEGER) AS year,
    CAST(MONTH(date_value) AS INTEGER) AS month, CAST(DAY(date_value) AS INTEGER) AS day,
    CAST(DAYOFWEEK(date_value) AS INTEGER) AS day_of_week, DAYOFWEEK(date_value) IN (0, 6) AS is_weekend
  FROM (SELECT DISTINCT date_value FROM li) d),
locations AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY SUBSTR(MD5(location), 1, 3), location) AS INTEGER) AS location_id,
    location AS location_name, latitude, longitude
  FROM (SELECT DISTINCT location, latitude, longitude FROM li) l)"""

FACT = f"""
fact AS (
  SELECT (CAST(d.date_id AS BIGINT) << 32) | (CAST(l.location_id AS BIGINT) << 5) | CAST(r.hour AS BIGINT) AS fact_id,
    d.date_id, l.location_id, r.hour, {", ".join("r." + m for m in _FEED)}
  FROM li r JOIN dates d USING (date_value) JOIN locations l ON l.location_name = r.location),
star AS (
  SELECT l.location_name, d.date_value, d.day_of_week, d.is_weekend, f.*
  FROM fact f JOIN locations l USING (location_id) JOIN dates d USING (date_id))"""

STAR = f"{LI},{DIMS},{FACT}"


def _units(value: str) -> str:
    """A double's shortest text as a whole number of 10^-18: integers add up the same in any order."""
    return f"CAST(REPLACE(CAST(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,18)) AS VARCHAR), '.', '') AS HUGEINT)"


def _double(units: str) -> str:
    return f"CAST(CAST({units} AS VARCHAR) || 'e-18' AS DOUBLE)"


def _tenths(total: str, count: str) -> str:
    step = f"(CAST({count} AS HUGEINT) * 100000000000000000)"
    return (
        f"CASE WHEN {count} > 0 THEN (CASE WHEN {total} < 0 THEN -1 ELSE 1 END) * "
        f"CAST((2 * ABS({total}) + {step}) // (2 * {step}) AS BIGINT) / 1e1 END"
    )


def _sum(value: str, over: str = "") -> str:
    return _double(f"SUM({_units(value)}) {over}")


def _avg_of_avgs(value: str) -> str:
    return f"{_sum(value)} / NULLIF(COUNT({value}), 0)"


def _sum_of_sums(value: str) -> str:
    return _sum(value)


MART = f"""
mart AS (
  SELECT CAST(location_id AS VARCHAR) || '-' || CAST(date_id AS VARCHAR) AS summary_id,
    date_id, location_id, location_name, date_value AS summary_date, is_weekend,
    MIN(temperature_2m) AS min_temp_c, MAX(temperature_2m) AS max_temp_c,
    {_sum("temperature_2m")} / NULLIF(COUNT(temperature_2m), 0) AS avg_temp_c,
    CAST(SUM(relative_humidity_2m) AS DOUBLE) / NULLIF(COUNT(relative_humidity_2m), 0) AS avg_humidity,
    {_sum("precipitation")} AS total_precipitation_mm, MAX(wind_speed_10m) AS max_wind_speed_kmh
  FROM star GROUP BY date_id, location_id, location_name, date_value, is_weekend)"""


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


_PLACE = "location_name, date_value"
_HISTORY = "PARTITION BY location_name ORDER BY hour, date_value"
_DAY = "PARTITION BY location_name, date_value ORDER BY hour"
_FRAME = "ROWS BETWEEN 2 PRECEDING AND CURRENT ROW"


def _change(window: str) -> str:
    return f"""
SELECT {_PLACE}, hour, temperature_2m, prev_hour_temp, {_tenths("change", "1")} AS temp_change FROM (
  SELECT *, {_units("temperature_2m")} - {_units("prev_hour_temp")} AS change FROM (
    SELECT *, LAG(temperature_2m) OVER ({window}) AS prev_hour_temp FROM star) a) b
ORDER BY location_name, date_value, hour"""


def _rolling(window: str) -> str:
    return f"""
SELECT {_PLACE}, hour, temperature_2m, {_tenths("t", "c")} AS moving_avg_3hr FROM (
  SELECT *, COUNT(temperature_2m) OVER ({window} {_FRAME}) AS c,
    SUM({_units("temperature_2m")}) OVER ({window} {_FRAME}) AS t
  FROM star) a
ORDER BY location_name, date_value, hour"""


def _rain(window: str) -> str:
    return f"""
SELECT {_PLACE}, hour, precipitation, {_sum("precipitation", f"OVER ({window})")} AS cumulative_precip
FROM star ORDER BY location_name, date_value, hour"""


_EXTREMES = f"""(SELECT {_PLACE}, MIN(temperature_2m) AS min_temp, MAX(temperature_2m) AS max_temp,
    MAX(temperature_2m) - MIN(temperature_2m) AS temp_variance
  FROM star GROUP BY {_PLACE}) s"""

_QUESTION_SQL = {
    "q1": f"""SELECT {_PLACE}, hour, temperature_2m, precipitation FROM star
ORDER BY location_name NULLS LAST, hour NULLS LAST, date_value NULLS LAST LIMIT 10""",
    "q2": f"SELECT {_PLACE}, hour, temperature_2m FROM star WHERE temperature_2m < 0 ORDER BY temperature_2m",
    "q3": f"""SELECT {_PLACE}, hour, wind_speed_10m, temperature_2m FROM star
WHERE wind_speed_10m > 15 ORDER BY wind_speed_10m DESC""",
    "q4": f"""SELECT {_PLACE}, day_of_week, hour, temperature_2m FROM star
WHERE is_weekend ORDER BY location_name, hour""",
    "q5": f"""SELECT {_PLACE}, hours_recorded, {_tenths("t", "c")} AS avg_temp FROM (
  SELECT {_PLACE}, COUNT(*) AS hours_recorded, COUNT(temperature_2m) AS c,
    SUM({_units("temperature_2m")}) AS t
  FROM star GROUP BY {_PLACE}) a ORDER BY avg_temp DESC NULLS FIRST""",
    "q6": f"""SELECT {_PLACE}, min_temp, max_temp, temp_variance FROM {_EXTREMES}
ORDER BY temp_variance DESC NULLS FIRST""",
    "q7": f"""SELECT location_name, {_sum("precipitation")} AS total_precipitation FROM star
GROUP BY location_name HAVING SUM({_units("precipitation")}) > 0 ORDER BY total_precipitation DESC""",
    "q8": f"""SELECT {_PLACE}, temp_category, COUNT(*) AS hours_count FROM (
  SELECT *, CASE WHEN temperature_2m < 10 THEN 'Cold' WHEN temperature_2m BETWEEN 10 AND 20 THEN 'Mild'
    ELSE 'Hot' END AS temp_category FROM star) a
GROUP BY {_PLACE}, temp_category ORDER BY location_name, hours_count DESC""",
    "q9": _change(_HISTORY),
    "q9_daily": _change(_DAY),
    "q10": _rolling(_HISTORY),
    "q10_daily": _rolling(_DAY),
    "q11": f"""SELECT {_PLACE}, hour, temperature_2m, CAST(RANK() OVER (
  PARTITION BY {_PLACE} ORDER BY temperature_2m DESC NULLS FIRST) AS INTEGER) AS heat_rank
FROM star ORDER BY location_name, date_value, heat_rank""",
    "q12": _rain("PARTITION BY location_name ORDER BY hour"),
    "q12_daily": _rain(_DAY),
    "q13": f"""SELECT {_PLACE}, max_temp, min_temp, temp_variance FROM {_EXTREMES}
WHERE temp_variance > 10 ORDER BY temp_variance DESC""",
}
assert _QUESTION_SQL.keys() == QUESTIONS.keys()

# ------------------------------------------------------------------ layers
_SILVER_EV = f"""SELECT time, {", ".join(_FEED)}, latitude, longitude, 'stations' AS source,
  run_date, location FROM ev"""
_STAGE_LI = f"""SELECT time, {", ".join(_FEED)}, latitude, longitude, location, 'stations' AS source,
  run_date FROM li"""


def _gold(readings: str) -> str:
    return f"""SELECT time, temperature_2m AS temp_celsius, relative_humidity_2m AS humidity_percent,
  wind_speed_10m AS wind_speed_kmh, precipitation AS precipitation_mm,
  ROUND(temperature_2m * 9 / 5 + 32, 2) AS temp_fahrenheit,
  COALESCE(temperature_2m <= 0, FALSE) AS is_freezing, latitude, longitude, location,
  run_date FROM {readings}"""


def _documents(keys: int) -> str:
    return f"""SELECT 'stations' AS source, run_date, location, latitude, longitude,
  {keys} AS n_keys, CAST(COUNT(*) AS INTEGER) AS n_hours
FROM ev GROUP BY run_date, location, latitude, longitude"""


_KEYS_LANDED = len(REQUIRED_KEYS) + 2

# The faults put into documents: see the input adapter.
_FAULTY = """
faulty AS (
  SELECT *, DAY(run_date) % 5 = 0 AS no_keys,
    location LIKE '%1' AND DAY(run_date) % 6 = 1 AS no_hours,
    CASE WHEN relative_humidity_2m % 23 = 0 THEN 'at ' || CAST(hour AS VARCHAR)
      ELSE STRFTIME(time, '%Y-%m-%dT%H:%M') END AS text,
    relative_humidity_2m % 23 = 0 AS bad
  FROM ev, LATERAL (SELECT UNNEST(CASE WHEN CAST(ROUND(wind_speed_10m * 10) AS INTEGER) % 19 = 0
    THEN [1, 2] ELSE [1] END) AS copy) c),
placed AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY run_date, location ORDER BY time, copy) - 1 AS pos
  FROM faulty WHERE NOT no_hours)"""

_HEAD = "'stations' AS source, run_date, location"

_DOCUMENT_CHECKS = {
    "dq_required_keys": f"""SELECT DISTINCT {_HEAD}, 'required_keys' AS check_name,
  'Data is missing required keys: timezone,elevation' AS detail, CAST(2 AS BIGINT) AS n
FROM faulty WHERE no_keys""",
    "dq_non_empty": f"""SELECT DISTINCT {_HEAD}, 'non_empty' AS check_name,
  'Dataset is empty' AS detail, CAST(1 AS BIGINT) AS n FROM faulty WHERE no_hours""",
    "dq_timestamps": f"""SELECT {_HEAD}, 'timestamps' AS check_name,
  'Found ' || CAST(COUNT(*) AS VARCHAR) || ' unparseable timestamps. Examples: ' || STRING_AGG(
    CASE WHEN nth <= 5 THEN '[' || CAST(pos AS VARCHAR) || '] ' || text END, '; ' ORDER BY pos) AS detail,
  COUNT(*) AS n
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY run_date, location ORDER BY pos) AS nth
  FROM placed WHERE bad) b GROUP BY run_date, location""",
    "dq_duplicates_bronze": f"""SELECT {_HEAD}, 'duplicates' AS check_name,
  'Data contains ' || CAST(COUNT(*) - COUNT(DISTINCT text) AS VARCHAR) || ' duplicates on natural key' AS detail,
  COUNT(*) - COUNT(DISTINCT text) AS n
FROM placed GROUP BY run_date, location HAVING COUNT(*) > COUNT(DISTINCT text)""",
}

_DATE_COLUMNS = "date_id, date_value, year, month, day, day_of_week, is_weekend"
_LOCATION_COLUMNS = "location_id, location_name, latitude, longitude"

_MERGED_LOCATIONS = """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY later, SUBSTR(MD5(location), 1, 3), location) AS INTEGER) AS location_id,
  location AS location_name, latitude, longitude
FROM (SELECT location, latitude, longitude,
    MIN(date_value) > (SELECT MIN(date_value) FROM li) AS later
  FROM li GROUP BY location, latitude, longitude) l"""

_UPSERT = f"""
SELECT date_value, location AS location_name, hour, temperature_2m AS temp_celsius,
  relative_humidity_2m AS humidity_percent, precipitation AS precipitation_mm, wind_speed_10m AS wind_speed_kmh
FROM (
  SELECT * FROM li WHERE date_value >= (SELECT start FROM changed)
  UNION ALL
  SELECT * FROM li_first WHERE date_value < (SELECT start FROM changed)) u"""
_UPSERT_CTES = f"""{LI},{_readings("li_first", "li_samples", "ASC")},
changed AS (
  SELECT CAST(DATE_TRUNC('month', MAX(date_value)) - INTERVAL 1 MONTH AS DATE) AS start FROM li)"""


def _constraints(**spoilt: str) -> str:
    rows = [
        ("dim_date", "unique", "date_id"), ("dim_date", "unique", "date_value"),
        ("dim_location", "unique", "location_id"), ("dim_location", "unique", "location_name"),
        ("fact_weather_hourly", "unique", "fact_id"),
    ]
    columns = {
        "dim_date": ("date_id", "date_value"),
        "dim_location": ("location_id", "location_name", "latitude", "longitude"),
        "fact_weather_hourly": ("fact_id", "date_id", "location_id", "hour"),
    }
    sources = {"dim_date": "dates", "dim_location": "locations", "fact_weather_hourly": "fact"} | spoilt
    parts = [
        f"SELECT '{t}' AS table_name, '{k}' AS constraint_type, '{c}' AS column_name, COUNT(*) AS n_failures "
        f"FROM (SELECT {c} FROM {sources[t]} GROUP BY {c} HAVING COUNT(*) > 1) x"
        for t, k, c in rows
    ]
    parts += [
        f"SELECT '{t}', 'not_null', '{c}', COUNT(*) FROM {sources[t]} WHERE {c} IS NULL"
        for t, names in columns.items() for c in names
    ]
    parts += [
        f"SELECT 'fact_weather_hourly', 'foreign_key', '{c}', COUNT(DISTINCT {c}) FROM {sources['fact_weather_hourly']} f "
        f"WHERE NOT EXISTS (SELECT 1 FROM {sources[parent]} p WHERE p.{c} = f.{c})"
        for c, parent in (("date_id", "dim_date"), ("location_id", "dim_location"))
    ]
    return "\nUNION ALL ".join(parts)


def _metric_columns(*names: str) -> str:
    columns = {
        "average_daily_temperature": _avg_of_avgs("avg_temp_c"),
        "total_daily_precipitation": _sum_of_sums("total_precipitation_mm"),
        "max_daily_wind_speed": "MAX(max_wind_speed_kmh)",
    }
    return ", ".join(f"{columns[name]} AS {name}" for name in names or columns)


def _on_mart(body: str) -> str:
    return _with(f"{STAR},{MART}", body)


def _layer_counts(layers: dict[str, tuple[str, str]]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{layer}' AS layer, {day} AS run_date, {count} AS row_count FROM ev GROUP BY {day}"
        for layer, (day, count) in layers.items()
    )


def expected_sql() -> dict[str, str]:
    sql = {name: _with(STAR, body) for name, body in _QUESTION_SQL.items()}
    sql |= {name: _with(f"{EV},{_FAULTY}", body) for name, body in _DOCUMENT_CHECKS.items()}
    sql |= {
        "bronze_scan": _with(EV, _documents(_KEYS_LANDED)),
        "bronze_land": _with(EV, _documents(_KEYS_LANDED)),
        "normalize_flatten": _with(EV, _SILVER_EV),
        "silver_scan": _with(EV, _SILVER_EV),
        "silver_write": _with(EV, _SILVER_EV),
        "mirror_write": _with(EV, _SILVER_EV),
        "silver_other_arrays": _with(
            EV,
            """SELECT time, location, temperature_2m,
  CASE WHEN relative_humidity_2m % 11 <> 0 THEN (relative_humidity_2m * 7 % 101) / 4e0 END AS cloud_cover,
  'say "' || relative_humidity_2m || '"' AS remark, CAST(2 AS INTEGER) AS n_others
FROM ev""",
        ),
        "curate_gold": _with(LI, _gold("li")),
        "gold_overwrite_idempotent": _with(EV, _gold("ev")),
        "gold_copy_full": _with(EV, _gold("ev")),
        "gold_copy_incremental": _with(
            EV, _gold("ev WHERE run_date = (SELECT MAX(run_date) FROM ev)")
        ),
        "path_metadata": _with(
            EV, "SELECT location, run_date, COUNT(*) AS n_rows FROM ev GROUP BY location, run_date"
        ),
        "path_names": _with(
            EV,
            """SELECT location, DATE '2024-01-01' AS run_date, COUNT(*) AS n_rows, COUNT(*) AS n_by_value FROM (
  SELECT ['St. John''s', 'A:B', '50%', 'a=b', 'x+y z', 'run_date=5', NULL]
    [1 + CAST(REGEXP_EXTRACT(location, '[0-9]+$') AS INTEGER) % 7] AS location FROM ev) x GROUP BY location""",
        ),
        "one_source_of_two": _with(
            EV, "SELECT date_value, location AS location_name, hour, temperature_2m AS temp_celsius FROM ev"
        ),
        "dq_row_reconcile": _with(
            EV, "SELECT layer, COUNT(*) AS row_count FROM ev, (VALUES ('silver'), ('gold')) v(layer) GROUP BY layer"
        ),
        "stage_replace": _with(LI, _STAGE_LI),
        "dim_date_build": _with(f"{LI},{DIMS}", f"SELECT {_DATE_COLUMNS} FROM dates"),
        "star_reload_date": _with(f"{LI},{DIMS}", f"SELECT {_DATE_COLUMNS} FROM dates"),
        "merge_dim_date": _with(f"{LI},{DIMS}", f"SELECT {_DATE_COLUMNS} FROM dates"),
        "stg_date": _with(f"{LI},{DIMS}", f"SELECT {_DATE_COLUMNS} FROM dates"),
        "dim_location_build": _with(f"{LI},{DIMS}", f"SELECT {_LOCATION_COLUMNS} FROM locations"),
        "star_reload_location": _with(f"{LI},{DIMS}", f"SELECT {_LOCATION_COLUMNS} FROM locations"),
        "stg_location": _with(f"{LI},{DIMS}", f"SELECT {_LOCATION_COLUMNS} FROM locations"),
        "merge_dim_location": _with(LI, _MERGED_LOCATIONS),
        "star_reload_fact": _with(STAR, "SELECT * FROM fact"),
        "stg_weather_hourly": _with(
            STAR,
            "SELECT fact_id, date_id, location_id, hour, temperature_2m AS temp_celsius, "
            "relative_humidity_2m AS humidity_percent, precipitation AS precipitation_mm, "
            "wind_speed_10m AS wind_speed_kmh FROM fact",
        ),
        "merge_fact_upsert": _with(_UPSERT_CTES, _UPSERT),
        "reload_then_merge": _with(_UPSERT_CTES, _UPSERT),
        "extraction_time": _with(
            _UPSERT_CTES,
            """SELECT date_value, location AS location_name, hour, TRUE AS stamped,
  date_value >= (SELECT start FROM changed) AS newer FROM li""",
        ),
        "named_tables": _with(LI, "SELECT location AS location_name, COUNT(*) AS n FROM li GROUP BY location"),
        "rebuild_then_load": _with(
            LI,
            """SELECT table_name, CAST(0 AS BIGINT) AS emptied, n AS reloaded FROM (
  SELECT 'dim_date' AS table_name, COUNT(DISTINCT date_value) AS n FROM li WHERE date_value = (SELECT MAX(date_value) FROM li)
  UNION ALL SELECT 'dim_location', COUNT(DISTINCT location) FROM li WHERE date_value = (SELECT MAX(date_value) FROM li)
  UNION ALL SELECT 'fact_weather_hourly', COUNT(*) FROM li WHERE date_value = (SELECT MAX(date_value) FROM li)) x""",
        ),
        "mart_daily_summary": _on_mart("SELECT * FROM mart"),
        "mart_scan": _on_mart("SELECT * FROM mart ORDER BY summary_date DESC"),
        "time_spine": _with(
            EV,
            """SELECT date_day, COUNT(ev.date_value) AS n_readings FROM (
  SELECT DATE '2020-01-01' + CAST(i AS INTEGER) AS date_day FROM RANGE(3650) r(i)) d
LEFT JOIN ev ON ev.date_value = d.date_day GROUP BY date_day""",
        ),
        "metric_by_location_weekend": _on_mart(
            f"SELECT location_name, is_weekend, {_metric_columns()} FROM mart GROUP BY location_name, is_weekend"
        ),
        "metric_by_month": _on_mart(
            f"SELECT CAST(DATE_TRUNC('month', summary_date) AS DATE) AS summary_date, {_metric_columns()} "
            "FROM mart GROUP BY 1"
        ),
        "dash_filtered": _on_mart(
            "SELECT * FROM mart WHERE summary_date BETWEEN DATE '1994-01-01' AND DATE '1996-12-31' "
            "AND location_name = 'loc_1'"
        ),
        "dash_kpis": _on_mart(
            f"""SELECT {_avg_of_avgs("avg_temp_c")} AS avg_temp,
  COALESCE({_sum_of_sums("total_precipitation_mm")}, 0) AS total_precip,
  MAX(max_wind_speed_kmh) AS max_wind, {_avg_of_avgs("avg_humidity")} AS avg_humidity FROM mart"""
        ),
        "dash_temp_trend": _on_mart(
            "SELECT summary_date, "
            + ", ".join(f"{_avg_of_avgs(n)} AS {n}" for n in ("min_temp_c", "avg_temp_c", "max_temp_c"))
            + " FROM mart GROUP BY summary_date"
        ),
        "dash_precip_trend": _on_mart(
            f"SELECT summary_date, COALESCE({_sum_of_sums('total_precipitation_mm')}, 0) "
            "AS total_precipitation_mm FROM mart GROUP BY summary_date"
        ),
        "dash_wind_humidity": _on_mart("SELECT avg_humidity, max_wind_speed_kmh, location_name FROM mart"),
        "dash_filter_options": _on_mart(
            """SELECT DISTINCT 'location' AS option, location_name AS value FROM mart
UNION ALL SELECT 'min_date', CAST(MIN(summary_date) AS VARCHAR) FROM mart
UNION ALL SELECT 'max_date', CAST(MAX(summary_date) AS VARCHAR) FROM mart"""
        ),
        "freshness": _on_mart(
            "SELECT MIN(summary_date) AS min_date, MAX(summary_date) AS max_date FROM mart"
        ),
        "dq_row_count": _with(
            STAR, "SELECT 'fact_weather_hourly' AS table_name, COUNT(*) AS row_count FROM fact"
        ),
        "dq_null_counts": _with(
            STAR,
            """SELECT COUNT(*) AS total_rows,
  CAST(SUM(CASE WHEN temperature_2m IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_temps,
  CAST(SUM(CASE WHEN precipitation IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_precip,
  CAST(SUM(CASE WHEN location_id IS NULL OR date_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS orphaned_records
FROM fact""",
        ),
        "dq_proof_join": _with(
            STAR,
            """SELECT date_value, location_name, hour, temperature_2m AS temp_celsius,
  wind_speed_10m AS wind_speed_kmh FROM star
ORDER BY date_value DESC, location_name NULLS LAST, hour LIMIT 15""",
        ),
        "dq_not_null": _with(
            STAR,
            "\nUNION ALL ".join(
                f"SELECT '{name}' AS column_name, COUNT(*) AS n_nulls FROM fact WHERE {column} IS NULL"
                for name, column in (
                    ("fact_id", "fact_id"), ("temp_celsius", "temperature_2m"),
                    ("precipitation_mm", "precipitation"),
                )
            ),
        ),
        "dq_unique": """SELECT l_orderkey, l_linenumber, COUNT(*) AS n_records FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
        "dq_relationships": _on_mart(
            """SELECT 'mart.date_id' AS reference, CAST(date_id AS BIGINT) AS value, COUNT(*) AS n_records
FROM mart WHERE date_id NOT IN (SELECT date_id FROM dates) GROUP BY date_id
UNION ALL SELECT 'mart.location_id', CAST(location_id AS BIGINT), COUNT(*)
FROM mart WHERE location_id NOT IN (SELECT location_id FROM locations) GROUP BY location_id
UNION ALL SELECT 'documents.doc_id', doc_id, COUNT(*)
FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL) GROUP BY doc_id"""
        ),
        "dq_duplicates_rows": _with(
            EVENT_SAMPLES,
            """SELECT latitude, longitude, location, date_value, hour, COUNT(*) AS n_records
FROM ev_samples GROUP BY ALL HAVING COUNT(*) > 1""",
        ),
        "dq_star_constraints": _with(STAR, _constraints()),
        "dq_star_constraints_faulty": _with(
            STAR + """,
bad_fact AS (
  SELECT fact_id, CASE WHEN fact_id % 101 <> 0 THEN hour END AS hour,
    CASE WHEN fact_id % 103 = 0 THEN location_id + 1000000 WHEN fact_id % 107 <> 0 THEN location_id END AS location_id,
    date_id + CASE WHEN fact_id % 109 = 0 THEN 70000000 ELSE 0 END AS date_id
  FROM (SELECT * FROM fact UNION ALL SELECT * FROM fact WHERE fact_id % 997 = 0 UNION ALL SELECT * FROM fact WHERE fact_id % 1993 = 0) f),
bad_dates AS (
  SELECT date_id, date_value FROM dates UNION ALL SELECT date_id + 50000000, date_value FROM dates WHERE day = 3
  UNION ALL SELECT date_id, date_value FROM dates WHERE day = 5 AND month < 4),
bad_locations AS (
  SELECT location_id, location_name, CASE WHEN location_id % 7 <> 0 THEN latitude END AS latitude, longitude FROM locations
  UNION ALL SELECT -location_id, location_name, latitude, longitude FROM locations WHERE location_id % 11 = 0)""",
            _constraints(dim_date="bad_dates", dim_location="bad_locations", fact_weather_hourly="bad_fact"),
        ),
        "q4_one_week": _with(
            STAR,
            f"""SELECT {_PLACE}, day_of_week, hour, temperature_2m FROM star
WHERE is_weekend AND date_value > (SELECT MAX(date_value) FROM dates) - INTERVAL 7 DAY""",
        ),
        "rerun_idempotent": _with(
            EV,
            f"""SELECT {_DATE_ID} AS date_id, COUNT(*) AS rows_first,
  CAST(SUM(CAST(ROUND(temperature_2m * 10) AS BIGINT)) AS BIGINT) AS temp_first, COUNT(*) AS rows_second,
  CAST(SUM(CAST(ROUND(temperature_2m * 10) AS BIGINT)) AS BIGINT) AS temp_second
FROM ev GROUP BY date_value""",
        ),
        "backfill_counts": _with(
            EV,
            _layer_counts(
                {"silver": ("run_date", "COUNT(*)"), "gold": ("run_date", "COUNT(*)"),
                 "fact": ("date_value", "COUNT(*)"), "mart": ("date_value", "COUNT(DISTINCT location)")}
            ),
        ),
    }
    for name in ("average_daily_temperature", "total_daily_precipitation", "max_daily_wind_speed"):
        sql[f"metric_{name}"] = _on_mart(
            f"SELECT summary_date, {_metric_columns(name)} FROM mart GROUP BY summary_date"
        )
    return sql
