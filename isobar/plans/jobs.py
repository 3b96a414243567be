"""Whole-table jobs, each over any number of dates and locations at once."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.operators.documents import assert_clean, check_bronze, flatten_hourly
from isobar.operators.merge import merge_dim_date, merge_dim_location, merge_fact
from isobar.operators.star import (
    Star, build_dim_date, build_dim_location, build_fact, distinct_dates, fact_rows,
)
from isobar.plans.marts import daily_summary, mart_tests, staging_views, time_spine
from isobar.sources.bronze import land_bronze, read_bronze
from isobar.sources.bundles import by_date
from isobar.sources.gold import read_gold, write_gold
from isobar.sources.layout import read_parquet
from isobar.sources.silver import read_silver, write_silver
from isobar.sources.warehouse import FACT_TABLE, Warehouse, replace_staging


def ingest(
    spark: SparkSession,
    bronze: str,
    silver: str,
    run_dates: Iterable[str] | None = None,
    locations: Iterable[str] | None = None,
    source: str | None = None,
    grain: str | None = None,
) -> int:
    """Bronze to silver in one pass over the documents, without a shuffle.

    ``grain`` is how a new silver layer is laid out. A document with findings fails the job before anything is committed; only then are the documents read again, to say which ones
    and why. Hourly arrays besides the four measures are kept in one map column.
    """
    dates = None if run_dates is None else list(run_dates)
    places = None if locations is None else list(locations)
    raw = read_bronze(spark, bronze, dates, places, source)
    try:
        return write_silver(flatten_hourly(raw, others=True), silver, align=False, grain=grain)
    except ValueError:
        raise
    except Exception:
        assert_clean(check_bronze(raw))
        raise


def curate_job(
    spark: SparkSession,
    silver: str,
    gold: str,
    run_dates: Iterable[str] | None = None,
    locations: Iterable[str] | None = None,
    source: str | None = None,
    grain: str | None = None,
) -> int:
    """Silver to gold for the given dates, locations and source; ``grain`` is how a new gold layer is laid out.

    Silver files belong to one gold partition each, so nothing has to be shuffled, unless many locations share a file
    of silver and gold has a folder for each.
    """
    align = by_date(spark, silver) and not by_date(spark, gold, grain)
    return write_gold(read_silver(spark, silver, run_dates, locations, source), gold, align=align, grain=grain)


def load_full_from(
    warehouse: Warehouse,
    silver: str,
    run_dates: Iterable[str] | None = None,
    locations: Iterable[str] | None = None,
    source: str | None = None,
) -> Star:
    """``load_full`` from silver folders of the given dates, locations and source."""
    return load_full(warehouse, read_silver(warehouse.spark, silver, run_dates, locations, source))


def load_full(warehouse: Warehouse, staged: DataFrame) -> Star:
    """Replace staging with silver rows and rebuild the star from it.

    All three tables are complete beside the old ones before the first is put in place: rows that fail the
    load leave the star as it was.
    """
    replace_staging(staged, warehouse)
    raw = warehouse.read("raw_weather")
    ready = {
        "dim_location": warehouse.stage("dim_location", build_dim_location(raw)),
        "dim_date": warehouse.stage("dim_date", build_dim_date(raw)),
    }
    locations, dates = (read_parquet(warehouse.spark, path, warehouse.schema(table)) for table, path in ready.items())
    ready[FACT_TABLE] = warehouse.stage(FACT_TABLE, build_fact(raw, dates, locations))
    for table, path in ready.items():
        warehouse.put(table, path)
    return read_star(warehouse)


def load_incremental(
    warehouse: Warehouse, gold: str, run_dates: Iterable[str] | None = None
) -> int:
    """Copy gold into staging, extend the dimensions, upsert the fact."""
    return load_staged(warehouse, read_gold(warehouse.spark, gold, run_dates))


def load_staged(warehouse: Warehouse, curated: DataFrame) -> int:
    """Copy rows into the staging table and merge the star from it."""
    replace_staging(curated, warehouse, "raw_weather_staging")
    return merge_star(warehouse, warehouse.read("raw_weather_staging"))


def merge_star(warehouse: Warehouse, staging: DataFrame) -> int:
    """Extend the dimensions and upsert the fact from staged rows."""
    merge_dim_location(warehouse, staging)
    merge_dim_date(warehouse, staging)
    dates, locations = warehouse.read("dim_date"), warehouse.read("dim_location")
    # The touched days come from the time column alone, before any join.
    return merge_fact(warehouse, fact_rows(staging, dates, locations), distinct_dates(staging))


def read_star(warehouse: Warehouse, first: str | None = None, last: str | None = None) -> Star:
    """The star, or its days from ``first`` to ``last``: both, or none.

    What the days say about the fact's folders, months or days, is worked out before the read is planned, so
    no file of another folder is listed.
    """
    dates, locations = warehouse.read("dim_date"), warehouse.read("dim_location")
    if first is None and last is None:
        return Star(warehouse.read(FACT_TABLE), dates, locations)
    days = run_dates_between(first, last)
    wanted = F.col("date_value").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return Star(warehouse.read_fact_days(days), dates.where(wanted), locations)


def build_marts(warehouse: Warehouse) -> dict[str, DataFrame]:
    """Views, mart and spine; returns the mart's tests, empty where they pass."""
    views = staging_views(warehouse)
    dates, locations = views["stg_date"], views["stg_location"]
    warehouse.replace(
        "mart_daily_weather_summary", daily_summary(views["stg_weather_hourly"], dates, locations)
    )
    warehouse.replace("metricflow_time_spine", time_spine(warehouse.spark))
    return mart_tests(warehouse.read("mart_daily_weather_summary"), dates, locations)


def run_dates_between(start: str, end: str) -> list[str]:
    first, last = date.fromisoformat(str(start)), date.fromisoformat(str(end))
    return [str(first + timedelta(days=n)) for n in range((last - first).days + 1)]


def backfill(
    spark: SparkSession,
    bronze: str,
    silver: str,
    gold: str,
    warehouse: Warehouse,
    start: str,
    end: str,
    source: str | None = None,
    grain: str | None = None,
) -> dict[str, DataFrame]:
    """Re-run a span of dates as one job per layer; rows are replaced, not repeated.

    ``grain`` is how new layers are laid out.
    """
    dates = run_dates_between(start, end)
    ingest(spark, bronze, silver, dates, source=source, grain=grain)
    curate_job(spark, silver, gold, dates, source=source, grain=grain)
    load_incremental(warehouse, gold, dates)
    return build_marts(warehouse)


__all__ = [
    "backfill", "build_marts", "curate_job", "ingest", "land_bronze", "load_full", "load_full_from",
    "load_incremental", "load_staged", "merge_star", "read_star", "run_dates_between",
]
