"""Thousands of small partition folders on a file system that tasks see as plain folders.

Where its native library is missing, as it is beside PySpark, Hadoop's local file system starts a process, ``chmod``, for each folder and
file that it makes: four for a partition folder with one small file, its check sums and the folder it is moved to, far more than the file itself costs. Here tasks make the
folders and files themselves, under the names that Spark's writer gives them. Other stores have no such processes; their folders are Spark's to write.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.sources.layout import NO_VALUE, local_path

#: Below a root, what was written there: (folder, n_rows), once for each file. Readers pass over the name.
LISTED = "_folders"
# What Spark's writer encodes in folder names, besides control characters.
_ENCODED = "\"#%'*/:=?\\{[]^\x7f"
# Files of the list; one from each task would cost what is saved here.
_LISTS = 8
# A file's rows are held up to so many bytes, then written as a row group.
_ROW_GROUP_BYTES = 32 << 20


def can_write(spark: SparkSession, root: str) -> bool:
    return local_path(spark, root) is not None


def write(df: DataFrame, root: str, keys: Sequence[str]) -> int:
    """Write ``df`` below ``root`` as ``partitionBy(*keys)`` would, a file for each folder and task, then the list of them; returns the rows.

    A task that is run again replaces its own files, by files with the same rows.
    """
    spark, root, keys = df.sparkSession, root.rstrip("/"), list(keys)
    texts = [F.col(key).cast("string") for key in keys]
    named = [F.when(~text.isin("", NO_VALUE), text).alias(key) for key, text in zip(keys, texts)]
    rows = df.select(*[name for name in df.columns if name not in keys], *named).sortWithinPartitions(*keys)
    files = _files(local_path(spark, root), keys, spark.version, spark._jvm.System.getProperty("sun.jnu.encoding"))
    rows.mapInArrow(files, "folder string, n_rows bigint").repartition(_LISTS).write.parquet(f"{root}/{LISTED}")
    return listed(spark, root).agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]


def listed(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema("folder string, n_rows bigint").parquet(f"{root}/{LISTED}")


def _files(root: str, keys: list[str], version: str, encoding: str):
    """What a task does with its rows, sorted by the keys; workers need nothing of this package for it.

    ``encoding`` is that of file names in the JVM, which looks for them later; what it lacks is a question mark there.
    """
    encoded, no_value, most = {*_ENCODED, *map(chr, range(1, 32))}, NO_VALUE, _ROW_GROUP_BYTES

    def write_files(batches: Iterator) -> Iterator:
        import itertools
        import os

        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark import TaskContext

        task = TaskContext.get()
        file = f"part-{task.partitionId():05d}.snappy.parquet"
        unready = f".{file}.{task.taskAttemptId()}"

        def name(value):
            return no_value if value is None else "".join(f"%{ord(c):02X}" if c in encoded else c for c in value)

        def runs():
            for batch in batches:
                start, data = 0, batch.select([n for n in batch.schema.names if n not in keys])
                # Readers take dates and times as Spark's writer means them.
                data = data.replace_schema_metadata({"org.apache.spark.version": version})
                for values, same in itertools.groupby(zip(*[batch.column(key).to_pylist() for key in keys])):
                    n = sum(1 for _ in same)
                    yield values, data.slice(start, n)
                    start += n

        done, found = set(), {"folder": [], "n_rows": []}
        for values, parts in itertools.groupby(runs(), key=lambda run: run[0]):
            folder = "/".join(f"{key}={name(value)}" for key, value in zip(keys, values))
            at = f"{root}/{folder}".encode(encoding, "replace")
            if at in done:
                raise FileExistsError(f"Two partitions of the name {at!r}")
            done.add(at)
            os.makedirs(at, exist_ok=True)
            target, aside = os.path.join(at, file.encode()), os.path.join(at, unready.encode())
            out, held, n_bytes, n_rows = None, [], 0, 0
            with open(aside, "wb") as sink:
                for _, part in parts:
                    out = out or pq.ParquetWriter(sink, part.schema, store_schema=False)
                    held.append(part)
                    n_bytes, n_rows = n_bytes + part.nbytes, n_rows + part.num_rows
                    if n_bytes >= most:
                        out.write_table(pa.Table.from_batches(held))
                        held, n_bytes = [], 0
                if held:
                    out.write_table(pa.Table.from_batches(held))
                out.close()
            os.replace(aside, target)
            found["folder"].append(folder)
            found["n_rows"].append(n_rows)
        yield pa.RecordBatch.from_pydict(found, schema=pa.schema([("folder", pa.string()), ("n_rows", pa.int64())]))

    return write_files
