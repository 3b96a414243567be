"""Bronze: raw JSON documents as text under source/run_date/location folders."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.schemas import BRONZE, BRONZE_PARTITIONS, KNOWN_LOCATIONS, LANDED, VIOLATION
from isobar.session import prepare
from isobar.sources import bundles, snapshots
from isobar.sources.layout import date_folders, only, partition_from_path, read_parquet, require_path

_SHOWN = 20


def read_bronze(
    spark: SparkSession,
    root: str,
    run_dates: Iterable[str] | None = None,
    locations: Iterable[str] | None = None,
    source: str | None = None,
    whole_files: bool = False,
) -> DataFrame:
    """Raw documents with their partition values and file path.

    ``land_bronze`` writes one document per line; ``whole_files`` is for documents
    put there by something else that spread over several lines. In a layer by date the file path ends in the location.
    """
    prepare(spark)
    require_path(spark, root, "bronze")
    root = root.rstrip("/")
    dates = None if run_dates is None else list(run_dates)
    if snapshots.has_snapshots(spark, root):
        paths = bundles.paths(spark, root, BRONZE_PARTITIONS, dates, source)
        if not paths:
            return spark.createDataFrame([], T.StructType([*BRONZE.fields, VIOLATION["file_path"]]))
        documents = read_parquet(spark, root, BRONZE, paths)
        path = F.concat("_metadata.file_path", F.lit("#location="), F.coalesce("location", F.lit("")))
        return only(documents.select("value", *BRONZE_PARTITIONS, path.alias("file_path")), dates, locations, source)
    paths = [root] if dates is None else date_folders(spark, root, dates, by_source=True)
    if not paths:
        return spark.createDataFrame([], T.StructType([*BRONZE.fields, VIOLATION["file_path"]]))
    reader = spark.read.schema(BRONZE).option("basePath", root)
    documents = reader.text(paths, wholetext=whole_files).select(
        "value", *BRONZE_PARTITIONS, F.col("_metadata.file_path").alias("file_path")
    )
    return only(documents, dates, locations, source)


def known_locations(spark: SparkSession) -> DataFrame:
    rows = [(name, lat, lon) for name, (lat, lon) in KNOWN_LOCATIONS.items()]
    return spark.createDataFrame(rows, "location string, latitude double, longitude double")


def landed_locations(
    spark: SparkSession, landed: str, run_dates: Iterable[str] | None = None, bundled: bool = False
) -> DataFrame:
    """Locations with landed files, from the file names, or the bundles' location column: no document is read."""
    require_path(spark, landed, "landed")
    if bundled:
        return read_landed(spark, landed, run_dates, bundled=True).select("location").distinct()
    folders = landed if run_dates is None else date_folders(spark, landed, run_dates)
    if not folders:
        return spark.createDataFrame([], "location string")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folders)
    return files.select(partition_from_path(F.col("path"), "location", is_uri=False).alias("location")).distinct()


def unknown_locations(locations: DataFrame, lookup: DataFrame) -> DataFrame:
    """Locations without an entry in the reference table."""
    return locations.join(lookup, "location", "left_anti")


def with_load_metadata(landed: DataFrame, source: str) -> DataFrame:
    """Add the load time and source to each raw document and put it on one line.

    The text is extended rather than parsed and rebuilt, so fields nobody declared
    survive. Line breaks outside strings mean nothing in JSON and cannot occur
    inside them.
    """
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    added = F.concat(
        F.lit('"ingestion_timestamp":"'), stamp,
        F.lit('","source":'), F.lit(json.dumps(source)), F.lit("}"),
    )
    line = F.trim(F.regexp_replace("value", r"[\r\n]+", " "))
    body = F.regexp_replace(line, r"\s*\}$", "")
    extended = (
        F.when(~line.endswith("}"), line)
        .when(body == "{", F.concat(body, added))
        .otherwise(F.concat(body, F.lit(","), added))
    )
    return landed.withColumn("value", extended).withColumn("source", F.lit(source))


def read_landed(
    spark: SparkSession, landed: str, run_dates: Iterable[str] | None = None, locations: Iterable[str] | None = None,
    bundled: bool = False,
) -> DataFrame:
    require_path(spark, landed, "landed")
    folders = [landed] if run_dates is None else date_folders(spark, landed, run_dates)
    if not folders:
        return spark.createDataFrame([], LANDED)
    if bundled:
        return only(read_parquet(spark, landed, LANDED, folders), None, locations)
    rows = spark.read.schema(LANDED).option("basePath", landed).text(folders, wholetext=True)
    return only(rows, None, locations)


def land_bronze(
    spark: SparkSession,
    landed: str,
    root: str,
    source: str,
    lookup: DataFrame | None = None,
    run_dates: Iterable[str] | None = None,
    locations: Iterable[str] | None = None,
    grain: str | None = None,
    bundled: bool = False,
) -> None:
    """Load landed JSON files, ``run_date=/location=`` folders, into bronze.

    ``run_dates`` and ``locations`` choose among them; only the folders of these dates are listed, read and replaced. ``bundled`` says
    that ``run_date=`` folders hold Parquet files of many documents (``value``, ``location``) instead. ``grain``, ``location`` or ``date``, is
    how a new bronze layer is laid out (``sources/bundles.py``); an existing one keeps its layout.
    """
    lookup = known_locations(spark) if lookup is None else lookup
    dates = None if run_dates is None else list(run_dates)
    places = None if locations is None else list(locations)
    wanted = only(landed_locations(spark, landed, dates, bundled), None, places)
    missing = unknown_locations(wanted, lookup)
    unknown = [row["location"] for row in missing.limit(_SHOWN).collect()]
    if unknown:
        raise LookupError(f"No coordinates known for locations: {', '.join(map(str, unknown))}")
    documents = with_load_metadata(read_landed(spark, landed, dates, places, bundled), source).select("value", *BRONZE_PARTITIONS)
    if bundles.by_date(spark, root, grain):
        bundles.put(documents, root, BRONZE, BRONZE_PARTITIONS, align=False)
        return
    # One file per document comes in, so tasks already write one file per partition.
    (
        documents.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*BRONZE_PARTITIONS)
        .text(root)
    )
