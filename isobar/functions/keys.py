"""Dense integer keys for a set of new names, without one task numbering them all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BUCKET_DIGITS = 3
BUCKETS = 16**BUCKET_DIGITS


def dense_ids(names: DataFrame, name: str, key: str, start: int) -> DataFrame:
    """Add ``key`` = ``start`` + 1, 2, ... over rows that are distinct on ``name``.

    The order is (hash prefix, name). Rows are numbered inside their hash bucket in
    parallel; only the bucket sizes, at most ``BUCKETS`` rows, meet in one task and
    are broadcast. The number depends on the data alone, so a recomputed task hands
    out the same keys.
    """
    bucketed = names.withColumn("_bucket", F.substring(F.md5(F.col(name)), 1, BUCKET_DIGITS))
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("_bucket").agg(F.count("*").alias("_size"))
        .select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    position = F.row_number().over(W.partitionBy("_bucket").orderBy(name))
    return (
        bucketed.withColumn("_position", position)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(key, (F.lit(start) + F.col("_offset") + F.col("_position")).cast("int"))
        .drop("_bucket", "_position", "_offset")
    )
