"""Silver: flat typed hourly rows under source/run_date/location folders."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.schemas import OTHER_HOURLY, SILVER, SILVER_PARTITIONS
from isobar.sources import bundles, snapshots
from isobar.sources.layout import (
    aligned, date_folders, leaf_folders, only, overwrite_partitions, path_exists, read_parquet, require_path,
)

_WITH_OTHERS = T.StructType([OTHER_HOURLY, *SILVER.fields])


def read_silver(
    spark: SparkSession,
    root: str,
    run_dates: Iterable[str] | None = None,
    locations: Iterable[str] | None = None,
    source: str | None = None,
    others: bool = False,
) -> DataFrame:
    """Silver rows; each predicate prunes folders before any file is opened.

    With ``others`` they have a map of what the documents' other hourly arrays say, by name, as JSON text; NULL where there were none.
    """
    require_path(spark, root, "silver")
    dates = None if run_dates is None else list(run_dates)
    schema = _WITH_OTHERS if others else SILVER
    if snapshots.has_snapshots(spark, root):
        folders = bundles.paths(spark, root, SILVER_PARTITIONS, dates, source)
        return only(read_parquet(spark, root, schema, folders), dates, locations, source)
    folders = None if dates is None else date_folders(spark, root, dates, by_source=True)
    return only(read_parquet(spark, root, schema, folders), dates, locations, source)


def write_silver(df: DataFrame, root: str, align: bool = True, grain: str | None = None) -> int:
    """Replace the partitions present in ``df``; an empty frame is an error.

    ``align=False`` saves the shuffle where each partition already comes from one
    file, as it does when documents are flattened. ``grain``, ``location`` or ``date``, is how a new layer is laid out
    (``sources/bundles.py``); an existing one keeps its layout.
    """
    rows = df.select(*_others(df), *[F.col(name).cast(SILVER[name].dataType) for name in SILVER.names])
    written = _put(rows, root, align, bundles.by_date(df.sparkSession, root, grain))
    if written == 0:
        raise ValueError("The normalised frame is empty")
    return written


def _put(rows: DataFrame, root: str, align: bool, by_date: bool) -> int:
    if by_date:
        return bundles.put(rows, root, _WITH_OTHERS, SILVER_PARTITIONS, align)
    return overwrite_partitions(aligned(rows, SILVER_PARTITIONS) if align else rows, root, SILVER_PARTITIONS)


def _others(df: DataFrame) -> list[str]:
    return [OTHER_HOURLY.name] if OTHER_HOURLY.name in df.columns else []


def mirror(df: DataFrame, root: str, check_exists: bool = False, grain: str | None = None) -> None:
    """Copy silver rows to a second root, laid out by ``grain`` if it is new.

    ``check_exists`` leaves partitions alone that the second root already has. Their names come from a listing of the
    dates in ``df``; no file of the second root is opened. Of a root by date the columns that name partitions are read.
    A partition without a name counts as missing.
    """
    spark, by_date = df.sparkSession, bundles.by_date(df.sparkSession, root, grain)
    if check_exists and by_date and snapshots.has_snapshots(spark, root):
        dates = [row["run_date"] for row in df.select("run_date").distinct().collect()]  # bounded by the calendar
        held = bundles.present(read_silver(spark, root, [day for day in dates if day is not None]), SILVER_PARTITIONS)
        df = df.join(held, list(SILVER_PARTITIONS), "left_anti")
    elif check_exists and path_exists(spark, root):
        dates = [row["run_date"] for row in df.select("run_date").distinct().collect()]  # bounded by the calendar
        folders = date_folders(spark, root, dates, by_source=True)
        if folders:
            present = leaf_folders(spark, folders, SILVER_PARTITIONS).drop("folder").withColumn("run_date", F.col("run_date").cast("date"))
            df = df.join(present, list(SILVER_PARTITIONS), "left_anti")
    _put(df.select(*_others(df), *SILVER.names), root, True, by_date)
