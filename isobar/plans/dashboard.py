"""The dashboard's selections and aggregates over the daily mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.functions.exact import avg_of_avgs, sum_of_sums

ALL_LOCATIONS = "All Locations"


def newest_first(mart: DataFrame) -> DataFrame:
    """Lower-case column names, a date-typed day, newest day first."""
    rows = mart.toDF(*[name.lower() for name in mart.columns])
    rows = rows.withColumn("summary_date", F.to_date("summary_date"))
    return rows.orderBy(F.col("summary_date").desc_nulls_first(), "location_name", "summary_id")


def filter_mart(
    mart: DataFrame,
    start: str | None = None,
    end: str | None = None,
    location: str | None = None,
) -> DataFrame:
    """Days from ``start`` to ``end`` inclusive, and one location or all.

    A single day selects that day. Without dates the whole span is kept, which needs
    no look-up of its ends: rows without a day fall out either way.
    """
    if (start is None) != (end is None):
        start = end = start if start is not None else end
    day = F.col("summary_date")
    if start is None:
        rows = mart.where(day.isNotNull())
    else:
        rows = mart.where(day.between(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")))
    if location is not None and location != ALL_LOCATIONS:
        rows = rows.where(F.col("location_name") == location)
    return rows


def kpis(selected: DataFrame) -> DataFrame:
    """Four figures; all 0.0 where nothing is selected."""
    def shown(value: Column, name: str) -> Column:
        return F.when(F.count(F.lit(1)) == 0, 0.0).otherwise(value).alias(name)

    return selected.agg(
        shown(avg_of_avgs(F.col("avg_temp_c")), "avg_temp"),
        # A sum over missing values only is 0.0 here, unlike in SQL.
        shown(F.coalesce(sum_of_sums(F.col("total_precipitation_mm")), F.lit(0.0)), "total_precip"),
        shown(F.max("max_wind_speed_kmh"), "max_wind"),
        shown(avg_of_avgs(F.col("avg_humidity")), "avg_humidity"),
    )


def temp_trend(selected: DataFrame) -> DataFrame:
    names = ("min_temp_c", "avg_temp_c", "max_temp_c")
    return selected.groupBy("summary_date").agg(*[avg_of_avgs(F.col(name)).alias(name) for name in names])


def precip_trend(selected: DataFrame) -> DataFrame:
    total = F.coalesce(sum_of_sums(F.col("total_precipitation_mm")), F.lit(0.0))
    return selected.groupBy("summary_date").agg(total.alias("total_precipitation_mm"))


def wind_humidity(selected: DataFrame, location: str | None = None) -> DataFrame:
    """Points of the wind and humidity chart, coloured by location where all are shown."""
    points = ["avg_humidity", "max_wind_speed_kmh"]
    if location is None or location == ALL_LOCATIONS:
        points.append("location_name")
    return selected.select(*points)


def filter_options(mart: DataFrame) -> DataFrame:
    """What the filters offer: every location, and the first and last day."""
    by_location = mart.groupBy("location_name").agg(
        F.min("summary_date").alias("_first"), F.max("summary_date").alias("_last")
    )
    names = by_location.select(F.lit("location").alias("option"), F.col("location_name").alias("value"))
    span = by_location.agg(F.min("_first").alias("min_date"), F.max("_last").alias("max_date"))
    ends = span.select(
        F.stack(
            F.lit(2),
            F.lit("min_date"), F.col("min_date").cast("string"),
            F.lit("max_date"), F.col("max_date").cast("string"),
        ).alias("option", "value")
    )
    return names.unionByName(ends)


def freshness(mart: DataFrame) -> DataFrame:
    return mart.agg(F.min("summary_date").alias("min_date"), F.max("summary_date").alias("max_date"))
