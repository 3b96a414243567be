"""Dimensions, fact and their joins."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.functions import calendar
from isobar.functions.keys import dense_ids
from isobar.schemas import DIM_DATE, DIM_LOCATION, FACT, FACT_KEYS, MEASURES


def fail_if(condition: Column, message: Column, value: Column) -> Column:
    """``value``, or a failed job where the condition holds."""
    return F.when(condition, F.raise_error(message)).otherwise(value)


def distinct_locations(staging: DataFrame) -> DataFrame:
    """One row per named location.

    A location with two coordinate pairs would double its fact rows in the joins, so
    it fails the load. Minimum and maximum combine map-side: a location holding most
    of the rows costs its tasks one partial row each.
    """
    grouped = staging.where(F.col("location").isNotNull()).groupBy("location").agg(
        F.min("latitude").alias("latitude"), F.max("latitude").alias("_lat"),
        F.min("longitude").alias("longitude"), F.max("longitude").alias("_lon"),
    )
    moved = (F.col("latitude") != F.col("_lat")) | (F.col("longitude") != F.col("_lon"))
    message = F.concat(F.lit("Location with two coordinate pairs: "), F.col("location"))
    name = fail_if(moved, message, F.col("location")).alias("location_name")
    return grouped.select(name, "latitude", "longitude")


def coordinate_conflicts(staging: DataFrame) -> DataFrame:
    """Locations that appear with more than one coordinate pair."""
    return (
        staging.where(F.col("location").isNotNull()).groupBy("location")
        .agg(
            F.min("latitude").alias("min_latitude"), F.max("latitude").alias("max_latitude"),
            F.min("longitude").alias("min_longitude"), F.max("longitude").alias("max_longitude"),
        )
        .where("min_latitude <> max_latitude OR min_longitude <> max_longitude")
    )


def distinct_dates(staging: DataFrame) -> DataFrame:
    """The date dimension's rows: distinct on the date, attributes derived after."""
    dates = staging.select(F.col("time").cast("date").alias("date_value")).distinct()
    date = F.col("date_value")
    return dates.select(
        calendar.date_id(date).alias("date_id"),
        fail_if(date.isNull(), F.lit("A staged row has no time"), date).alias("date_value"),
        F.year(date).alias("year"),
        F.month(date).alias("month"),
        F.dayofmonth(date).alias("day"),
        calendar.day_of_week(date).alias("day_of_week"),
        calendar.is_weekend(date).alias("is_weekend"),
    )


def build_dim_date(staging: DataFrame) -> DataFrame:
    return distinct_dates(staging).select(*DIM_DATE.names)


def build_dim_location(staging: DataFrame, start: int = 0) -> DataFrame:
    numbered = dense_ids(distinct_locations(staging), "location_name", "location_id", start)
    return numbered.select(*DIM_LOCATION.names)


def fact_rows(staging: DataFrame, dates: DataFrame, locations: DataFrame) -> DataFrame:
    """Staged rows with names replaced by dimension keys.

    The date table is broadcast: it has one row per calendar day, tens of thousands for
    a century and never more than 3.7 million. Locations have no such bound, so Spark
    broadcasts them below its size threshold only; beyond it they are merge-joined and
    AQE splits hot locations.
    """
    staging = staging.withColumnsRenamed(MEASURES)
    measures = [name for name in staging.columns if name in MEASURES.values()]
    keyed = staging.select(
        F.col("time").cast("date").alias("date_value"),
        F.col("location").alias("location_name"),
        F.hour("time").alias("hour"),
        *measures,
    )
    return (
        keyed.join(F.broadcast(dates.select("date_id", "date_value")), "date_value")
        .join(locations.select("location_id", "location_name"), "location_name")
        .select("date_id", "location_id", "hour", *measures)
    )


def build_fact(staging: DataFrame, dates: DataFrame, locations: DataFrame) -> DataFrame:
    """All fact rows of a reload; two staged rows for one key fail it, as they fail a merge."""
    rows = fact_rows(staging, dates, locations)
    single = rows.groupBy(*FACT_KEYS).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.max(name).alias(name) for name in MEASURES.values()]
    )
    message = F.concat_ws(" ", F.lit("Two source rows for fact key"), *FACT_KEYS)
    hour = fail_if(F.col("_rows") > 1, message, F.col("hour"))
    return single.withColumns(
        {
            "fact_id": calendar.fact_id(F.col("date_id"), F.col("location_id"), hour),
            "extraction_time": F.current_timestamp(),
        }
    ).select(*FACT.names)


@dataclass(frozen=True)
class Star:
    """A fact with its two dimensions."""

    fact: DataFrame
    dates: DataFrame
    locations: DataFrame

    def feed_named(self) -> Star:
        """The same star with the feed's measure names, which the hourly queries use."""
        back = {gold: feed for feed, gold in MEASURES.items()}
        return Star(self.fact.withColumnsRenamed(back), self.dates, self.locations)

    def with_dates(self, rows: DataFrame) -> DataFrame:
        """One row per calendar day bounds the broadcast side."""
        return rows.join(F.broadcast(self.dates), "date_id")

    def with_locations(self, rows: DataFrame) -> DataFrame:
        names = self.locations.select("location_id", "location_name")
        return rows.join(names, "location_id")

    def name(self, rows: DataFrame) -> DataFrame:
        """Attach both dimensions to rows that carry both keys.

        Queries that group do so on the keys first, so what is joined, and shuffled if
        a dimension is too large to broadcast, is the grouped result.
        """
        return self.with_locations(self.with_dates(rows))
