"""Settings that are put on a session."""

from pyspark.sql import functions as F

from isobar.session import prepare

MOST = "spark.sql.files.maxPartitionBytes"


def test_what_a_task_reads_is_bounded(spark, folder):
    """Before, a task took 128 MB of compressed rows however much memory it needed to group them."""
    try:
        for given, kept in (("128MB", 16 << 20), (str(1 << 30), 16 << 20), ("1m", 1 << 20)):
            spark.conf.set(MOST, given)
            prepare(spark)
            assert spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(MOST)) == kept
        spark.range(2_000_000).select(F.rand(1).alias("x")).coalesce(1).write.option("parquet.block.size", 1 << 20).parquet(folder("t"))
        assert spark.read.parquet(folder("t")).rdd.getNumPartitions() > 8
    finally:
        spark.conf.unset(MOST)
        prepare(spark)
