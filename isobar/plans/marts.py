"""Staging views, the daily mart, the time spine and their tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.functions.exact import exact_avg, exact_sum
from isobar.operators import quality
from isobar.schemas import DIM_DATE, DIM_LOCATION, FACT, MART
from isobar.sources.warehouse import Warehouse

STAGING_VIEWS = {
    "stg_date": ("dim_date", DIM_DATE.names),
    "stg_location": ("dim_location", DIM_LOCATION.names),
    "stg_weather_hourly": ("fact_weather_hourly", FACT.names),
}

# ---------------------------------------------------------------- fixed values
SPINE_START = "2020-01-01"
SPINE_DAYS = 3650
# -----------------------------------------------------------------------------


def staging_views(warehouse: Warehouse) -> dict[str, DataFrame]:
    """Named views with explicit column lists over the warehouse tables."""
    views = {}
    for name, (table, columns) in STAGING_VIEWS.items():
        views[name] = warehouse.read(table).select(*columns)
        views[name].createOrReplaceTempView(name)
    return views


def daily_summary(fact: DataFrame, dates: DataFrame, locations: DataFrame) -> DataFrame:
    """One row per location and day.

    The fact is grouped on its two keys before the joins; the dimensions then meet
    one row per location and day instead of one per hour.
    """
    daily = fact.groupBy("location_id", "date_id").agg(
        F.min("temp_celsius").alias("min_temp_c"),
        F.max("temp_celsius").alias("max_temp_c"),
        exact_avg(F.col("temp_celsius")).alias("avg_temp_c"),
        (F.sum("humidity_percent").cast("double")
         / F.nullif(F.count("humidity_percent"), F.lit(0))).alias("avg_humidity"),
        exact_sum(F.col("precipitation_mm")).alias("total_precipitation_mm"),
        F.max("wind_speed_kmh").alias("max_wind_speed_kmh"),
    )
    days = dates.select("date_id", F.col("date_value").alias("summary_date"), "is_weekend")
    return (
        daily.join(F.broadcast(days), "date_id")  # one row per calendar day
        .join(locations.select("location_id", "location_name"), "location_id")
        .withColumn("summary_id", F.concat(F.col("location_id"), F.lit("-"), F.col("date_id")))
        .select(*MART.names)
    )


def time_spine(spark: SparkSession, start: str = SPINE_START, days: int = SPINE_DAYS) -> DataFrame:
    """Consecutive days from ``start``."""
    first = F.lit(start).cast("date")
    span = F.sequence(first, F.date_add(first, days - 1), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(span).alias("date_day"))


def mart_tests(mart: DataFrame, dates: DataFrame, locations: DataFrame) -> dict[str, DataFrame]:
    """The mart's declared tests; each DataFrame is empty where its test passes."""
    missing = quality.not_null(mart, ["summary_id", "date_id", "location_id"]).where("n_nulls > 0")
    return {
        "unique_summary_id": quality.unique(mart, ["summary_id"]),
        "not_null": missing,
        "relationships_date_id": quality.relationships(mart, "date_id", dates, "date_id"),
        "relationships_location_id": quality.relationships(mart, "location_id", locations, "location_id"),
    }
