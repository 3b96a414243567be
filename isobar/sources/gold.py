"""Gold: curated rows under run_date/location folders, published as snapshots."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.operators.curate import curate
from isobar.schemas import GOLD, GOLD_PARTITIONS
from isobar.sources import bundles, snapshots
from isobar.sources.layout import (
    aligned, date_folders, drop_scratch, only, partition_from_path, path_exists, read_files, read_parquet, require_path, uncoalesced,
)

# A folder costs some milliseconds, however few rows it takes.
_FOLDERS_A_TASK = 250


def read_gold(spark: SparkSession, root: str, run_dates: Iterable[str] | None = None) -> DataFrame:
    """Gold rows in staging column order; ``run_dates`` prunes folders."""
    require_path(spark, root, "gold")
    dates = None if run_dates is None else list(run_dates)
    if snapshots.has_snapshots(spark, root):
        wanted = None if dates is None else F.col("run_date").isin([str(day) for day in dates]) if dates else F.lit(False)
        return only(snapshots.read(spark, root, GOLD, snapshots.keys_of(spark, root), wanted), dates)
    folders = None if dates is None else date_folders(spark, root, dates)
    return only(read_parquet(spark, root, GOLD, folders), dates)


def read_gold_by_path(spark: SparkSession, root: str) -> DataFrame:
    """The same rows, location and run date cut out of the file path instead; the layer has to be laid out by location."""
    require_path(spark, root, "gold")
    bundles.by_date(spark, root, "location")
    measured = [field for field in GOLD if field.name not in GOLD_PARTITIONS]
    if snapshots.has_snapshots(spark, root):
        versioned, plain = snapshots.folders(spark, root, GOLD_PARTITIONS)
        data = read_files(spark, versioned + plain, T.StructType(measured))
    else:
        data = read_gold(spark, root)
    path = F.col("_metadata.file_path")
    return data.select(
        *[field.name for field in measured],
        partition_from_path(path, "location").alias("location"),
        partition_from_path(path, "run_date").cast("date").alias("run_date"),
    )


def write_gold(silver: DataFrame, root: str, align: bool = True, grain: str | None = None) -> int:
    """Curate silver rows and replace their gold partitions.

    Rows are counted on both sides of the projection by the one pass that writes them, as a version that nobody reads; only if the
    counts agree is it published, in one step for all its partitions. Two sources for one run date and location would meet in one partition and double its rows: that fails
    before anything is written; the check reads partition values only. ``grain``, ``location`` or ``date``, is how a new layer is laid
    out (``sources/bundles.py``); an existing one keeps its layout.
    """
    sources = silver.groupBy(*GOLD_PARTITIONS).agg(F.min("source").alias("a"), F.max("source").alias("b"))
    mixed = F.when(F.col("a") != F.col("b"), F.struct(*GOLD_PARTITIONS, "a", "b"))
    found = sources.agg(F.count(F.lit(1)).alias("n"), F.max(mixed).alias("mixed")).first()
    if row := found["mixed"]:
        raise ValueError(f"Sources {row['a']} and {row['b']} meet in {row['run_date']}, {row['location']}: name one source")
    many = found["n"] > 2 * _FOLDERS_A_TASK
    seen = Observation()
    curated = curate(silver.observe(seen, F.count(F.lit(1)).alias("rows")))
    by_date = bundles.by_date(silver.sparkSession, root, grain)
    spark, fresh = silver.sparkSession, not path_exists(silver.sparkSession, root)
    unpublished = root
    try:
        if by_date:
            written = bundles.write_version(curated, root, GOLD_PARTITIONS, align)
        else:
            tasks = -(-found["n"] // _FOLDERS_A_TASK) if many else None
            with uncoalesced(spark, many):
                rows = aligned(curated, GOLD_PARTITIONS, tasks) if align else curated
                written = snapshots.write_version(rows, root, GOLD_PARTITIONS, many)
        unpublished = root if fresh else f"{root.rstrip('/')}/{written.name}"
        before = seen.get["rows"]
        if before == 0:
            raise ValueError("There are no silver rows to curate")
        if written.rows != before:
            raise ValueError(f"Row counts differ: silver {before}, gold {written.rows}")
        if by_date:
            bundles.publish(spark, root, written.name, GOLD, GOLD_PARTITIONS)
        else:
            snapshots.publish(spark, root, written.name, GOLD_PARTITIONS)
    except Exception:
        if fresh or unpublished != root:
            drop_scratch(spark, unpublished)
        raise
    return written.rows
