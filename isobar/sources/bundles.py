"""Layers whose folders are dates: a file holds many locations, and the location is a column in it.

A folder for each location and date, the layout of a few places, costs a file, a listing and a rename for each document, however
small. Here a layer is published as snapshots (``sources/snapshots.py``) with one folder for each source and run date. What is replaced is
still the single location: of a date that is written again, rows of locations that the new rows do not have are carried over.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.sources import snapshots
from isobar.sources.layout import aligned, children, drop_scratch, leaf_folders, path_exists, read_parquet

_MEMBER = "location"


def by_date(spark: SparkSession, root: str, grain: str | None = None) -> bool:
    """Whether a layer's folders are dates: as it is, or as ``grain``, ``location`` (the default) or ``date``, asks of a new one."""
    if grain not in (None, "location", "date"):
        raise ValueError(f"A layer is laid out by location or by date, not by {grain}")
    found, keys = None, snapshots.keys_of(spark, root)
    if keys is not None:
        found = "location" if _MEMBER in keys else "date"
    elif any("=" in name and not name.startswith("version=") for name in children(spark, root)):
        found = "location"
    if found and grain and found != grain:
        raise ValueError(f"The layer at {root} is laid out by {found}, not by {grain}")
    return (found or grain) == "date"


def paths(
    spark: SparkSession, root: str, partitions: Sequence[str], run_dates: Iterable[str] | None = None, source: str | None = None
) -> list[str]:
    """Folders of the given dates and source; ``partitions`` ends in the location."""
    wanted = []
    if run_dates is not None:
        days = [str(day) for day in run_dates]
        wanted.append(F.col("run_date").isin(days) if days else F.lit(False))
    if source is not None:
        wanted.append(F.col("source") == source)
    # Such a layer has had snapshots from the start, so no folder lies outside a version.
    return snapshots.folders(spark, root, _folders(partitions), reduce(Column.__and__, wanted) if wanted else None)[0]


def _folders(partitions: Sequence[str]) -> list[str]:
    return [name for name in partitions if name != _MEMBER]


def present(rows: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """The partitions that rows belong to; no other column is read."""
    return rows.select(*partitions).distinct()


def without(rows: DataFrame, names: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Rows of partitions that are not among ``names``; a missing value equals a missing one."""
    other = names.select(*[F.col(name).alias(f"_{name}") for name in partitions])
    same = reduce(Column.__and__, [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in partitions])
    return rows.join(other, same, "left_anti")


def write_version(df: DataFrame, root: str, partitions: Sequence[str], align: bool = True) -> snapshots.Version:
    """Write rows where no reader sees them yet; what a failed job has written is deleted."""
    spark, keys = df.sparkSession, _folders(partitions)
    # As a folder's name would have it, an empty name is a missing one.
    rows = df.withColumn(_MEMBER, F.nullif(F.col(_MEMBER), F.lit("")))
    before = set(children(spark, root))
    try:
        return snapshots.write_version(aligned(rows, keys) if align else rows, root, keys)
    except Exception:
        for name in set(children(spark, root)) - before:
            drop_scratch(spark, f"{root.rstrip('/')}/{name}")
        if not before and path_exists(spark, root):
            drop_scratch(spark, root)
        raise


def publish(spark: SparkSession, root: str, version: str, schema: T.StructType, partitions: Sequence[str]) -> None:
    """Carry over what the written dates keep, and make the version the state of its dates."""
    root, keys = root.rstrip("/"), _folders(partitions)
    written = f"{root}/{version}"
    if snapshots.has_snapshots(spark, root):
        # One row for each source and date.
        touched = [row["folder"] for row in leaf_folders(spark, [written], keys).select("folder").collect()]
        old = snapshots.read(spark, root, schema, keys, F.col("folder").isin(touched))
        kept = without(old, present(read_parquet(spark, written, schema), partitions), partitions)
        kept.write.mode("append").partitionBy(*keys).parquet(written)
    snapshots.publish(spark, root, version, keys)


def put(df: DataFrame, root: str, schema: T.StructType, partitions: Sequence[str], align: bool = True) -> int:
    """Replace exactly the partitions present in ``df``; returns its rows. Without rows nothing changes."""
    spark = df.sparkSession
    fresh = not path_exists(spark, root)
    written = write_version(df, root, partitions, align)
    if written.rows:
        publish(spark, root, written.name, schema, partitions)
    else:
        drop_scratch(spark, root if fresh else f"{root.rstrip('/')}/{written.name}")
    return written.rows
