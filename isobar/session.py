"""Session settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

from isobar.sources.layout import byte_size

# Settings the results depend on; they are safe to set on a running session.
_RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # A document that repeats a key keeps the last value, as JSON readers commonly do.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

_PLAN_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# Most bytes of files that one task reads. Readings are compressed some tenfold: the map of a task that groups 128 MB of them, Spark's
# default, takes several GB of memory, or spills, as soon as there is more input than that for every core.
_MOST_READ = "spark.sql.files.maxPartitionBytes"
_MOST_READ_BYTES = 16 << 20
# Tasks that list one folder's many children; by Spark's default there are up to 10,000, each for a folder or so.
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_LISTING_TASKS = 256


def build_session(app: str, cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in {**_RESULT_SETTINGS, **_PLAN_SETTINGS}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session made by someone else, and bound what a task reads and how many list folders; smaller bounds are kept."""
    for key, value in _RESULT_SETTINGS.items():
        spark.conf.set(key, value)
    if byte_size(spark, spark.conf.get(_MOST_READ)) > _MOST_READ_BYTES:
        spark.conf.set(_MOST_READ, str(_MOST_READ_BYTES))
    if int(spark.conf.get(_LISTING)) > _LISTING_TASKS:
        spark.conf.set(_LISTING, str(_LISTING_TASKS))
    return spark
