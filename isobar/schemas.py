"""Fixed column names and types of every layer."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------- fixed values
# Top-level keys every landed document has to carry, in reporting order.
REQUIRED_KEYS = (
    "latitude",
    "longitude",
    "generationtime_ms",
    "utc_offset_seconds",
    "timezone",
    "timezone_abbreviation",
    "elevation",
    "hourly_units",
    "hourly",
)

# The four hourly measures: feed name, and the name analysts see from gold on.
MEASURES = {
    "temperature_2m": "temp_celsius",
    "relative_humidity_2m": "humidity_percent",
    "precipitation": "precipitation_mm",
    "wind_speed_10m": "wind_speed_kmh",
}

# Known places and their coordinates.
KNOWN_LOCATIONS = {"Boston": (42.3601, -71.0589)}
# -----------------------------------------------------------------------------

_MEASURE_TYPES = {
    "temperature_2m": T.DoubleType(),
    "relative_humidity_2m": T.IntegerType(),
    "precipitation": T.DoubleType(),
    "wind_speed_10m": T.DoubleType(),
}

BRONZE_PARTITIONS = ("source", "run_date", "location")
SILVER_PARTITIONS = ("source", "run_date", "location")
GOLD_PARTITIONS = ("run_date", "location")


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


BRONZE = _struct(
    ("value", T.StringType()),
    ("source", T.StringType()),
    ("run_date", T.DateType()),
    ("location", T.StringType()),
)

LANDED = _struct(
    ("value", T.StringType()),
    ("run_date", T.DateType()),
    ("location", T.StringType()),
)

SILVER = _struct(
    ("time", T.TimestampNTZType()),
    *_MEASURE_TYPES.items(),
    ("latitude", T.DoubleType()),
    ("longitude", T.DoubleType()),
    ("source", T.StringType()),
    ("run_date", T.DateType()),
    ("location", T.StringType()),
)

# Hourly arrays besides the four measures: name to value, as JSON text. Silver files carry it beside SILVER's columns.
OTHER_HOURLY = T.StructField("other_hourly", T.MapType(T.StringType(), T.StringType()))

GOLD = _struct(
    ("time", T.TimestampNTZType()),
    ("temp_celsius", T.DoubleType()),
    ("humidity_percent", T.IntegerType()),
    ("wind_speed_kmh", T.DoubleType()),
    ("precipitation_mm", T.DoubleType()),
    ("temp_fahrenheit", T.DoubleType()),
    ("is_freezing", T.BooleanType()),
    ("latitude", T.DoubleType()),
    ("longitude", T.DoubleType()),
    ("location", T.StringType()),
    ("run_date", T.DateType()),
)

RAW_WEATHER = _struct(
    ("time", T.TimestampNTZType()),
    *_MEASURE_TYPES.items(),
    ("latitude", T.DoubleType()),
    ("longitude", T.DoubleType()),
    ("location", T.StringType()),
    ("source", T.StringType()),
    ("run_date", T.DateType()),
)

DIM_DATE = _struct(
    ("date_id", T.IntegerType()),
    ("date_value", T.DateType()),
    ("year", T.IntegerType()),
    ("month", T.IntegerType()),
    ("day", T.IntegerType()),
    ("day_of_week", T.IntegerType()),
    ("is_weekend", T.BooleanType()),
)

DIM_LOCATION = _struct(
    ("location_id", T.IntegerType()),
    ("location_name", T.StringType()),
    ("latitude", T.DoubleType()),
    ("longitude", T.DoubleType()),
)


def _fact(names: tuple[str, ...]) -> T.StructType:
    kinds = tuple(_MEASURE_TYPES.values())
    return _struct(
        ("fact_id", T.LongType()),
        ("date_id", T.IntegerType()),
        ("location_id", T.IntegerType()),
        ("hour", T.IntegerType()),
        *zip(names, kinds),
        ("extraction_time", T.TimestampType()),
    )


# The hourly questions use the feed's measure names; the table has gold's.
FACT_FEED = _fact(tuple(MEASURES))
FACT = _fact(tuple(MEASURES.values()))

MART = _struct(
    ("summary_id", T.StringType()),
    ("date_id", T.IntegerType()),
    ("location_id", T.IntegerType()),
    ("location_name", T.StringType()),
    ("summary_date", T.DateType()),
    ("is_weekend", T.BooleanType()),
    ("min_temp_c", T.DoubleType()),
    ("max_temp_c", T.DoubleType()),
    ("avg_temp_c", T.DoubleType()),
    ("avg_humidity", T.DoubleType()),
    ("total_precipitation_mm", T.DoubleType()),
    ("max_wind_speed_kmh", T.DoubleType()),
)

TIME_SPINE = _struct(("date_day", T.DateType()))

VIOLATION = _struct(
    ("file_path", T.StringType()),
    ("source", T.StringType()),
    ("run_date", T.DateType()),
    ("location", T.StringType()),
    ("check_name", T.StringType()),
    ("detail", T.StringType()),
    ("n", T.LongType()),
)

FACT_KEYS = ("date_id", "location_id", "hour")
