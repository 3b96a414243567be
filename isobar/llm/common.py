"""Shared folder, written tables, code for the workers, and distributed running sums."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid
import zipfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_SHIPPED: set[str] = set()


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder name below spark.checkpoint.dir, which driver and executors share.

    Only a session that names no such folder (tests on one machine) gets a temporary one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="isobar-llm-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/llm/{label}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, label: str, compression: str = "none") -> DataFrame:
    """The rows of ``df`` as a table in the shared folder: computed once, safe from lost executors.

    What operators keep is mostly hashes, which do not compress; without a codec the many small files of a short table need no
    buffers outside the heap either.
    """
    path = shared_folder(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.kept_at = path
    return table


def discard(table: DataFrame) -> None:
    """Delete a table of ``written`` that nothing reads any more; what was made from it has to be written by then."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table.kept_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Arrow batches to and from Python workers are cut at so many bytes; Spark's own default, and no other setting, gives way to it.
BATCH_BYTES = 8 << 20
_DEFAULT_BATCH_BYTES = 64 << 20


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, and have whole texts travel in small batches."""
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(limit).rstrip("b") == str(_DEFAULT_BATCH_BYTES):
        spark.conf.set(limit, str(BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="isobar-code-"), "isobar_code.zip")
    with zipfile.ZipFile(target, "w") as bundle:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    bundle.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def lighten() -> None:
    """At the start of a task: Spark keeps Python workers, and what an encoder of an earlier stage holds in this one is not needed."""
    used = sys.modules.get("isobar.llm.pieces")
    if used is not None:
        used.forget()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def block_of(key: Column, blocks: int) -> Column:
    """The block, 0 to ``blocks`` - 1, of a random 64-bit key; blocks keep the keys' order."""
    top = F.shiftrightunsigned(key.bitwiseXOR(F.lit(-(2**63))), 33)  # 31 bits, in signed order
    return F.floor(top * F.lit(blocks) / F.lit(2.0**31)).cast("int")


def blocks_for(rows: int, rows_per_block: int = 4_000) -> int:
    return max(1, -(-rows // rows_per_block))


def running_before(
    df: DataFrame, groups: Sequence[str], order: Sequence[str], block: str, value: str, name: str
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of the group that come before, by block and order.

    ``block`` rises with the order. A window over one row per block gives what the earlier blocks
    hold, a window inside each block gives the rest: no task sees a whole group. A NULL group is
    a group of its own.
    """
    groups = list(groups)
    sums = df.groupBy(*groups, block).agg(F.sum(value).alias("_block_sum"))
    over_blocks = Window.partitionBy(*groups).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        *[F.col(c).alias(f"_b_{c}") for c in [*groups, block]],
        F.coalesce(F.sum("_block_sum").over(over_blocks), F.lit(0)).alias("_blocks_before"),
    )
    inside = Window.partitionBy(*groups, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    same = [F.col(c).eqNullSafe(F.col(f"_b_{c}")) for c in [*groups, block]]
    joined = rows.join(sums.hint("merge"), same)  # its files say little about its size
    return joined.select(*df.columns, (F.col("_inside") + F.col("_blocks_before")).alias(name))


def in_order(df: DataFrame, order: Sequence[Column], label: str) -> DataFrame:
    """``df``, better a written table, sorted by ``order`` over all parts and written, with _part and, within it, _place."""
    at = F.monotonically_increasing_id()  # the part's number above 33 bits, the row's place in it below
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(dealt.select("*", F.shiftright(at, 33).alias("_part"), at.bitwiseAND(F.lit((1 << 33) - 1)).alias("_place")), label)


def numbered(ordered: DataFrame, groups: Sequence[str], name: str, by_group: DataFrame | None = None) -> DataFrame:
    """A table of ``in_order`` whose order begins with ``groups``, with ``name``: a row's number, from 0, in its group.

    ``by_group`` has a row for each group; its other columns are added too. Rows meet them by group and part, so that no
    group, however large, is in one task. Without groups there is one number for each part, few enough for every task.
    """
    kept = [c for c in ordered.columns if c not in ("_part", "_place")]
    counts = ordered.groupBy(*groups, "_part").agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    earlier = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *[F.col(c).alias(f"_g_{c}") for c in groups], F.col("_part").alias("_g_part"),
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    more = [c for c in by_group.columns if c not in groups] if by_group is not None else []
    if more:
        known = by_group.select(*[F.col(c).alias(f"_h_{c}") for c in groups], *more)
        starts = starts.join(known.hint("merge"), [F.col(f"_g_{c}").eqNullSafe(F.col(f"_h_{c}")) for c in groups])
    same = [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in groups] + [F.col("_part") == F.col("_g_part")]
    joined = ordered.join(starts.hint("merge") if groups else F.broadcast(starts), same)
    return joined.select(*kept, (F.col("_place") + F.col("_shift")).alias(name), *more)
