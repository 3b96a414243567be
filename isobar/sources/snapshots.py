"""Partitioned tables whose folders change all at once, by one new file name.

``root/version=<id>/<key>=<value>/...`` holds what one job wrote; a version never changes once it is written. ``root/_snapshots`` has a
Parquet table for each state of the table: which version holds each partition now. An empty file ``<number>-<id>`` beside them makes
table ``<id>`` the state, and creating it is all that publishing does: readers see the whole old state or the whole new one, and
no call is made for any folder, however many change. Tables of the plain layout, ``root/<key>=<value>/...``, are read as they are, and their folders
become part of the first snapshot where they stand.

One writer at a time is assumed; two that publish the same number are told so.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.sources import many_folders
from isobar.sources.layout import (
    children, create_file, drop_scratch, leaf_folders, partition_from_path, path_exists, read_parquet,
)

_SNAPSHOTS = "_snapshots"
# Tasks put their files in place as they end, not the driver one after the other: nobody reads a version before it is published.
_BY_TASKS = ("mapreduce.fileoutputcommitter.algorithm.version", "2")
_COMMIT = re.compile(r"(\d{10})-([0-9a-f]{12})")
#: States that readers may still be at: what none of the last ones names is deleted.
KEPT = 2


@dataclass(frozen=True)
class Version:
    """What one job wrote: its name (a folder below the root) and its rows."""

    name: str
    rows: int


def _commits(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """Numbers and table ids of all states, ascending, from one listing."""
    found = (_COMMIT.fullmatch(name) for name in children(spark, f"{root}/{_SNAPSHOTS}"))
    return sorted((int(m[1]), m[2]) for m in found if m)


def _schema(keys: Sequence[str]) -> T.StructType:
    """The version (NULL: plain layout), the folder below it, how many folders the version and its topmost folder have, and the values."""
    texts, counts = [T.StructField(n, T.StringType()) for n in ("version", "folder")], [T.StructField(n, T.LongType()) for n in ("n_version", "n_top")]
    return T.StructType([*texts, *counts, *(T.StructField(k, T.StringType()) for k in keys)])


def _table(spark: SparkSession, root: str, table: str, keys: Sequence[str]) -> DataFrame:
    return spark.read.schema(_schema(keys)).parquet(f"{root}/{_SNAPSHOTS}/table-{table}")


def keys_of(spark: SparkSession, root: str) -> list[str] | None:
    """Partition columns of a table that has snapshots."""
    root = root.rstrip("/")
    commits = _commits(spark, root)
    if not commits:
        return None
    return spark.read.parquet(f"{root}/{_SNAPSHOTS}/table-{commits[-1][1]}").columns[4:]


def _listed(spark: SparkSession, root: str, version: str | None, keys: Sequence[str]) -> DataFrame:
    """The folders of a version, or those of the plain layout, as rows of a snapshot."""
    if version and path_exists(spark, f"{root}/{version}/{many_folders.LISTED}"):
        folders = many_folders.listed(spark, f"{root}/{version}").select("folder").distinct()
        found = folders.select("folder", *[partition_from_path(F.col("folder"), key, is_uri=False).alias(key) for key in keys])
    else:
        names = [version] if version else [n for n in children(spark, root) if not n.startswith(("version=", "_", "."))]
        if not names:
            return spark.createDataFrame([], _schema(keys))
        found = leaf_folders(spark, [f"{root}/{name}" for name in names], keys)
    found = found.withColumn("_top", F.substring_index("folder", "/", 1))
    tops = found.groupBy("_top").agg(F.count("*").alias("n_top"))
    total = tops.agg(F.sum("n_top")).first()[0]
    return found.join(tops, "_top").select(
        F.lit(version).cast("string").alias("version"), "folder", F.lit(total).cast("long").alias("n_version"), "n_top", *keys
    )


def write_version(df: DataFrame, root: str, keys: Sequence[str], many: bool = False) -> Version:
    """Write rows below ``root`` where no reader sees them yet; ``many`` says that there are thousands of folders, each small."""
    name = f"version={uuid.uuid4().hex[:12]}"
    if many and many_folders.can_write(df.sparkSession, root):
        return Version(name, many_folders.write(df, f"{root.rstrip('/')}/{name}", keys))
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.option(*_BY_TASKS).partitionBy(*keys).parquet(f"{root.rstrip('/')}/{name}")
    return Version(name, seen.get["rows"])


def publish(spark: SparkSession, root: str, version: str, keys: Sequence[str], whole: bool = False) -> None:
    """Make a written version's folders those of the table; with ``whole`` it is the whole table. May be repeated."""
    root, keys = root.rstrip("/"), list(keys)
    commits = _commits(spark, root)
    rows = _listed(spark, root, version, keys)
    if not whole:
        old = _table(spark, root, commits[-1][1], keys) if commits else _listed(spark, root, None, keys)
        rows = old.where(F.coalesce(F.col("version") != version, F.lit(True))).join(rows.select("folder"), "folder", "left_anti").unionByName(rows)
    table = uuid.uuid4().hex[:12]
    rows.select(*_schema(keys).names).write.parquet(f"{root}/{_SNAPSHOTS}/table-{table}")
    number = commits[-1][0] + 1 if commits else 1
    create_file(spark, f"{root}/{_SNAPSHOTS}/{number:010d}-{table}")
    if sum(n == number for n, _ in _commits(spark, root)) > 1:
        drop_scratch(spark, f"{root}/{_SNAPSHOTS}/{number:010d}-{table}")
        raise RuntimeError(f"Another writer published at the same time at {root}")
    drop_unused(spark, root)


def drop_unused(spark: SparkSession, root: str, keep: int = KEPT) -> None:
    """Delete versions that none of the last ``keep`` states names, one call each, and older states."""
    root = root.rstrip("/")
    commits = _commits(spark, root)
    if len(commits) <= keep:
        return
    for number, table in commits[:-keep]:
        drop_scratch(spark, f"{root}/{_SNAPSHOTS}/{number:010d}-{table}")
        drop_scratch(spark, f"{root}/{_SNAPSHOTS}/table-{table}")
    named = spark.read.schema("version string").parquet(*[f"{root}/{_SNAPSHOTS}/table-{table}" for _, table in commits[-keep:]])
    used = {row["version"] for row in named.distinct().collect()}  # a row for each version
    for name in children(spark, root):
        if name.startswith("version=") and name not in used:
            drop_scratch(spark, f"{root}/{name}")


def folders(spark: SparkSession, root: str, keys: Sequence[str], only: Column | None = None) -> tuple[list[str], list[str]]:
    """Paths of the state's folders, those in versions and plain ones; ``only`` is a condition on the keys' texts.

    A version or topmost folder all of whose folders are wanted is one path.
    """
    root = root.rstrip("/")
    rows = _table(spark, root, _commits(spark, root)[-1][1], keys)
    rows = (rows if only is None else rows.where(only)).withColumn("_top", F.substring_index("folder", "/", 1))
    by_top = rows.groupBy("version", "_top").agg(
        F.count("*").alias("n"), F.first("n_top").alias("n_top"), F.first("n_version").alias("n_version"),
        F.collect_list(F.when(F.col("n_top") > 1, F.col("folder"))).alias("leaves"),
    )
    leaves = F.when(F.col("n") == F.col("n_top"), F.array("_top")).otherwise(F.col("leaves"))
    by_version = by_top.groupBy("version").agg(
        F.sum("n").alias("n"), F.first("n_version").alias("n_version"), F.flatten(F.collect_list(leaves)).alias("parts")
    )
    whole = F.col("version").isNotNull() & (F.col("n") == F.col("n_version"))
    found = by_version.select("version", F.when(whole, F.array(F.lit(""))).otherwise(F.col("parts")).alias("parts"))
    versioned: list[str] = []
    plain: list[str] = []
    for row in found.collect():  # as many paths as the read has to be given
        above = root if row["version"] is None else f"{root}/{row['version']}"
        (plain if row["version"] is None else versioned).extend(f"{above}/{part}".rstrip("/") for part in row["parts"])
    return sorted(versioned), sorted(plain)


def has_snapshots(spark: SparkSession, root: str) -> bool:
    return path_exists(spark, f"{root.rstrip('/')}/{_SNAPSHOTS}") and bool(_commits(spark, root.rstrip("/")))


def read(spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], only: Column | None = None) -> DataFrame:
    """The table's present state under its declared schema; only the wanted folders are listed."""
    versioned, plain = folders(spark, root, keys, only)
    if not plain:
        return read_parquet(spark, root, schema, versioned)
    rows = read_parquet(spark, root, schema, plain)
    return rows.unionByName(read_parquet(spark, root, schema, versioned)) if versioned else rows
