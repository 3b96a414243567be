"""Hive-style partition folders: paths, partition values, overwriting writes."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Readers pass over names that begin with an underscore.
_ASIDE = "_aside-"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# Tasks that take partition values from file names.
_NAMING_TASKS = 256
# What opening a file counts for beside its bytes where many small files are read.
_OPENING = "spark.sql.files.openCostInBytes"
_OPENING_BYTES = 64 << 10
_COALESCE = "spark.sql.adaptive.coalescePartitions.enabled"


def partition_path(root: str, source: str, run_date: str, location: str | None = None) -> str:
    path = f"{root.rstrip('/')}/source={source}/run_date={run_date}"
    return f"{path}/location={location}" if location else path


def partition_from_path(path: Column, name: str, is_uri: bool = True) -> Column:
    """A partition value taken from a file path.

    The partition writer percent-encodes values in folder names, and a URI (``_metadata.file_path``) encodes the names once
    more. The writer's name for a missing value is NULL.
    """
    value = F.regexp_extract(path, f"(?:^|/){name}=([^/]*)", 1)
    for _ in range(2 if is_uri else 1):
        value = F.coalesce(F.try_url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))), value)
    return F.when(~value.isin("", NO_VALUE), value)


def only(
    df: DataFrame,
    run_dates: Iterable[str] | None = None,
    locations: Iterable[str] | None = None,
    source: str | None = None,
) -> DataFrame:
    """Keep the given partitions; all three predicates prune folders."""
    if run_dates is not None:
        days = [F.lit(str(day)).cast("date") for day in run_dates]
        df = df.where(F.col("run_date").isin(*days) if days else F.lit(False))
    if locations is not None:
        names = list(locations)
        df = df.where(F.col("location").isin(*names) if names else F.lit(False))
    if source is not None:
        df = df.where(F.col("source") == source)
    return df


def date_folders(
    spark: SparkSession, root: str, run_dates: Iterable[str], by_source: bool = False, source: str | None = None
) -> list[str]:
    """The folders of the given dates that exist, below each source where there are sources.

    One listing of the root, and one for each source, however many dates are asked for. Reading these folders under
    ``basePath`` lists the wanted dates only; reading the root and filtering prunes as well, but lists every
    folder of the whole history first.
    """
    root, wanted = root.rstrip("/"), {f"run_date={day}" for day in run_dates}
    above = [root]
    if by_source:
        named = None if source is None else f"source={source}"
        above = [f"{root}/{n}" for n in children(spark, root) if n.startswith("source=") and named in (None, n)]
    return [f"{folder}/{name}" for folder in above for name in children(spark, folder) if name in wanted]


def read_parquet(
    spark: SparkSession, root: str, schema: T.StructType, folders: list[str] | None = None
) -> DataFrame:
    """Read a layout, or some of its folders, under its declared schema.

    Partition columns are in the schema, so a location called ``7`` stays a string
    and no footer is opened to infer types.
    """
    root = root.rstrip("/")
    if folders is not None and not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", root)
    return reader.parquet(*(folders or [root])).select(*schema.names)


def read_files(spark: SparkSession, folders: list[str], schema: T.StructType) -> DataFrame:
    """The Parquet files below ``folders`` under their own columns; what their paths say is in ``_metadata.file_path`` alone.

    Spark takes partition values from all paths one after the other, and by its default a task reads four files, however small. Here no
    value is taken, and a task reads as many files as it may read bytes, ``_OPENING_BYTES`` more for each. A read goes by the settings of the session
    that made it, so it is made in a copy of the session; the rows are the session's own.
    """
    if not folders:
        return spark.createDataFrame([], schema)
    other = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    if byte_size(spark, spark.conf.get(_OPENING)) > _OPENING_BYTES:
        other.conf.set(_OPENING, str(_OPENING_BYTES))
    rows = other.read.schema(schema).option("recursiveFileLookup", "true").parquet(*folders)
    return DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, rows._jdf.logicalPlan()), spark)


def byte_size(spark: SparkSession, size: str) -> int:
    """A size as settings give it, ``128MB`` or a number, in bytes."""
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def aligned(df: DataFrame, keys: Sequence[str], tasks: int | None = None) -> DataFrame:
    """Bring rows of one partition together before a partitioned write.

    Rebalancing lets AQE cut a partition that holds much of the data into several
    well-sized files and merge small ones; a plain repartition on the keys would
    hand a hot partition to one task. ``tasks`` is how many to deal the partitions to where ``uncoalesced`` keeps them.
    """
    return df.hint("rebalance", *([] if tasks is None else [tasks]), *[F.col(key) for key in keys])


@contextmanager
def uncoalesced(spark: SparkSession, active: bool = True) -> Iterator[None]:
    """Tasks stay as dealt, whatever they hold: those that write thousands of tiny files take time by file, not by byte. Hot ones are
    cut all the same.
    """
    before = spark.conf.get(_COALESCE)
    if active:
        spark.conf.set(_COALESCE, "false")
    try:
        yield
    finally:
        spark.conf.set(_COALESCE, before)


def overwrite_partitions(df: DataFrame, root: str, keys: Sequence[str]) -> int:
    """Replace exactly the partitions present in ``df``; returns the rows written.

    The files appear when the whole job commits: a failed or guarded job leaves the
    target as it was, and a lost executor only repeats tasks.
    """
    seen = Observation()
    (
        df.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(root.rstrip("/"))
    )
    return seen.get["rows"]


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path as programs of the machine have it, if it is on the machine's own file system."""
    files, hadoop_path = _file_system(spark, path)
    return files.makeQualified(hadoop_path).toUri().getPath() if files.getUri().getScheme() == "file" else None


def path_exists(spark: SparkSession, path: str) -> bool:
    files, hadoop_path = _file_system(spark, path)
    return files.exists(hadoop_path)


def path_state(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Bytes, files and modification time: differs when the data below was rewritten."""
    files, hadoop_path = _file_system(spark, path)
    summary = files.getContentSummary(hadoop_path)
    changed = files.getFileStatus(hadoop_path).getModificationTime()
    return summary.getLength(), summary.getFileCount(), changed


def require_path(spark: SparkSession, path: str, what: str) -> None:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"No {what} data at {path}")


def beside(path: str, label: str) -> str:
    """A new folder name next to ``path``, so that putting it in place moves names, not data."""
    return f"{path.rstrip('/')}-{label}-{uuid.uuid4().hex[:12]}"


def _aside(path: str) -> str:
    above, name = path.rstrip("/").rsplit("/", 1)
    return f"{above}/{_ASIDE}{name}"


def swap_in(spark: SparkSession, written: str, path: str) -> None:
    """Put a completely written folder in the place of an old one.

    The old folder is moved aside, and deleted when the new one is in place. If that fails it is moved
    back, here or by the next ``restore``.
    """
    files, target = _file_system(spark, path)
    source = _file_system(spark, written)[1]
    aside = beside(_aside(path), "")
    held = files.exists(target)
    if held and not files.rename(target, _file_system(spark, aside)[1]):
        raise RuntimeError(f"Could not move {path} aside")
    if not (files.exists(source) and files.rename(source, target)):
        restore(spark, path)
        raise RuntimeError(f"Could not move {written} to {path}")
    if held:
        files.delete(_file_system(spark, aside)[1], True)


def restore(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, after moving back what a swap that was cut short had moved aside."""
    files, target = _file_system(spark, path)
    if files.exists(target):
        return True
    aside = files.globStatus(_file_system(spark, f"{_aside(path)}-*")[1])
    if not aside:
        return False
    return files.rename(max(aside, key=lambda s: s.getModificationTime()).getPath(), target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names right below a folder, from one listing; none if it does not exist."""
    files, hadoop_path = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(hadoop_path)) if files.exists(hadoop_path) else []


def create_file(spark: SparkSession, path: str) -> None:
    """An empty file, made in one step; one of that name must not exist."""
    files, target = _file_system(spark, path)
    if not files.createNewFile(target):
        raise FileExistsError(path)


def leaf_folders(spark: SparkSession, roots: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Partition folders with data files below ``roots``: (folder, values), the folder as its last names, one for each key.

    The files' names are rows that Spark lists in parallel; no file is opened, so a task may have any number of them.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        .load(list(roots)).select("path").coalesce(_NAMING_TASKS)
    )
    values = [partition_from_path(F.col("path"), key, is_uri=False).alias(key) for key in keys]
    names = "/".join(f"{re.escape(key)}=[^/]*" for key in keys)
    return files.select(F.regexp_extract("path", f"({names})/[^/]*$", 1).alias("folder"), *values).where("folder <> ''").distinct()


def move_files(spark: SparkSession, source: str, path: str) -> None:
    """Move the data files of one folder into another. Spark's file names are unique."""
    files, target = _file_system(spark, path)
    files.mkdirs(target)
    for name in children(spark, source):
        if not name.startswith(("_", ".")):
            here, there = (_file_system(spark, f"{folder}/{name}")[1] for folder in (source, path))
            if not files.rename(here, there):
                raise RuntimeError(f"Could not move {here} to {path}")


def drop_scratch(spark: SparkSession, path: str, at_exit: bool = False) -> None:
    """Delete a scratch folder, now or when the session ends."""
    files, hadoop_path = _file_system(spark, path)
    if at_exit:
        files.deleteOnExit(hadoop_path)
    else:
        files.delete(hadoop_path, True)
