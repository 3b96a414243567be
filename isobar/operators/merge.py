"""Merges into warehouse tables kept as plain Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.functions import calendar
from isobar.functions.keys import dense_ids
from isobar.operators.star import distinct_dates, distinct_locations, fail_if
from isobar.schemas import DIM_DATE, DIM_LOCATION, FACT_KEYS
from isobar.sources import snapshots
from isobar.sources.layout import aligned, drop_scratch, read_parquet
from isobar.sources.warehouse import FACT_TABLE, Warehouse, with_fact_folder


def merge_insert_only(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key the target lacks. Known rows are never updated."""
    return source.join(target.select(*keys), keys, "left_anti").select(*source.columns)


def merge_dim_date(warehouse: Warehouse, staging: DataFrame) -> None:
    new = merge_insert_only(warehouse.read("dim_date"), distinct_dates(staging), ["date_value"])
    warehouse.append("dim_date", new.select(*DIM_DATE.names))


def new_locations(known: DataFrame, staging: DataFrame) -> DataFrame:
    """New locations with keys that continue after the highest one given out."""
    new = merge_insert_only(known, distinct_locations(staging), ["location_name"])
    last = known.agg(F.coalesce(F.max("location_id"), F.lit(0)).alias("last")).first()["last"]
    return dense_ids(new, "location_name", "location_id", last).select(*DIM_LOCATION.names)


def merge_dim_location(warehouse: Warehouse, staging: DataFrame) -> None:
    warehouse.append("dim_location", new_locations(warehouse.read("dim_location"), staging))


def upserted(target: DataFrame, source: DataFrame) -> DataFrame:
    """Target rows updated from, and extended by, the source.

    Both sides go into one aggregation on the natural key, where the source wins. It
    combines map-side and costs one shuffle; an anti-join plus a union would shuffle
    the same rows and the source twice. Two source rows with one key make the outcome
    of a merge arbitrary and fail the job.
    """
    values = [name for name in target.columns if name not in (*FACT_KEYS, "fact_id")]
    both = target.select(*FACT_KEYS, *values, F.lit(0).alias("_new")).unionByName(
        source.select(*FACT_KEYS, *values, F.lit(1).alias("_new"))
    )
    merged = both.groupBy(*FACT_KEYS).agg(
        F.sum("_new").alias("_sources"),
        *[F.max_by(name, "_new").alias(name) for name in values],
    )
    message = F.concat_ws(" ", F.lit("Two source rows for fact key"), *FACT_KEYS)
    hour = fail_if(F.col("_sources") > 1, message, F.col("hour"))
    ids = calendar.fact_id(F.col("date_id"), F.col("location_id"), hour)
    return merged.withColumn("fact_id", ids).select(*target.columns)


def merge_fact(warehouse: Warehouse, source: DataFrame, days: DataFrame | None = None) -> int:
    """Upsert fact rows; returns the rows in the rewritten folders.

    Only folders the source touches are read and written. ``days`` names the touched
    ``date_id`` values where the caller knows them more cheaply than by evaluating
    the source. The result is written as a version of the fact that nobody reads, counted, and published: all its folders take the
    place of the old ones in one step. A job that dies before leaves the fact as it was.
    """
    spark, path = warehouse.spark, warehouse.path(FACT_TABLE)
    folder = warehouse.fact_folder
    stamped = source.withColumn("extraction_time", F.current_timestamp())
    days = source.select("date_id") if days is None else days.select("date_id")
    # Bounded by the calendar: one value per touched day or month.
    touched = sorted(row[folder] for row in with_fact_folder(days, folder).select(folder).distinct().collect())
    if not touched:
        return 0
    target = warehouse.read_fact_folders(folder, touched)
    merged = aligned(with_fact_folder(upserted(target, stamped), folder), [folder])
    written = snapshots.write_version(merged, path, [folder])
    schema = warehouse.fact_schema(folder)
    found = read_parquet(spark, f"{path}/{written.name}", schema).count()
    if found != written.rows:
        drop_scratch(spark, f"{path}/{written.name}")
        raise RuntimeError(f"Wrote {found} of {written.rows} fact rows; the fact is as it was")
    promote_fact(warehouse, written.name)
    return written.rows


def promote_fact(warehouse: Warehouse, version: str) -> None:
    """Publish a version of the fact that was written completely; may be repeated."""
    snapshots.publish(warehouse.spark, warehouse.path(FACT_TABLE), version, [warehouse.fact_folder])
