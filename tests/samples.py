"""Documents and small tables the tests share."""

from __future__ import annotations

import json
import os

from pyspark.sql import functions as F

COMPLETE = {
    "latitude": 42.36, "longitude": -71.06, "generationtime_ms": 0.5, "utc_offset_seconds": -18000,
    "timezone": "America/New_York", "timezone_abbreviation": "EST", "elevation": 10.0,
    "hourly_units": {},
    "hourly": {
        "time": ["2026-01-25T12:00:00", "2026-01-25T13:00:00"],
        "temperature_2m": [35.5, 36.0], "relative_humidity_2m": [50, 51],
        "precipitation": [0.0, 0.4], "wind_speed_10m": [12.5, 15.1],
    },
}


def document(hourly=None, **changes):
    doc = {**COMPLETE, **changes}
    if hourly is not None:
        doc["hourly"] = hourly
    return doc


def hours(*times, **measures):
    return {"time": list(times), **measures}


def raw(spark, *documents):
    """Bronze rows as ``read_bronze`` gives them."""
    rows = [
        (d if isinstance(d, str) else json.dumps(d), f"doc-{i}") for i, d in enumerate(documents)
    ]
    return spark.createDataFrame(rows, "value string, file_path string").select(
        "value", F.lit("stations").alias("source"), F.lit("2026-01-25").cast("date").alias("run_date"),
        F.lit("Boston").alias("location"), "file_path",
    )


def land(root, run_date, location, doc, indent=None):
    path = os.path.join(root, f"run_date={run_date}", f"location={location}")
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "raw.json"), "w") as out:
        out.write(doc if isinstance(doc, str) else json.dumps(doc, indent=indent))


SILVER_DDL = (
    "time string, temperature_2m double, relative_humidity_2m int, precipitation double, "
    "wind_speed_10m double, location string"
)


def silver(spark, rows, coordinates=(42.36, -71.06)):
    """Silver rows from (time, temperature, humidity, rain, wind, location)."""
    frame = spark.createDataFrame(rows, SILVER_DDL)
    time = F.col("time").cast("timestamp_ntz")
    return frame.select(
        time.alias("time"), "temperature_2m", "relative_humidity_2m", "precipitation", "wind_speed_10m",
        F.lit(coordinates[0]).alias("latitude"), F.lit(coordinates[1]).alias("longitude"),
        F.lit("stations").alias("source"), F.to_date(time).alias("run_date"), "location",
    )


def rows(df, *names):
    picked = df.select(*names) if names else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
