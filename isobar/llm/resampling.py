"""Importance resampling towards a target distribution: hashed word runs, log ratios of counts, the highest perturbed weights.

Every document is scanned once; its runs' buckets are kept, two bytes each, and all later steps read those.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.llm.common import in_order, numbered, ship, written
from isobar.llm.crc_grams import Prefixes

BUCKETS = 10_000
LONGEST_RUN = 2
SHARE_PERCENT = 25
LEAST_WORDS = 20
SEED = 7
_BYTES_AT_ONCE = 1 << 22


def _portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of some megabytes of text; a longer text is a piece of its own."""
    sizes = np.cumsum(pc.binary_length(batch.column("text")).fill_null(0).to_numpy(), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        held = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, held + _BYTES_AT_ONCE, side="right")))
        yield batch.slice(at, end - at)
        at = end


def word_runs(docs: DataFrame, columns: list[str], longest: int = LONGEST_RUN, buckets: int = BUCKETS) -> DataFrame:
    """``columns``, n_words and the buckets of all runs of 1 to ``longest`` words of the text, as packed 16-bit numbers.

    A run's bucket is the CRC-32 of its words, joined by one space, modulo ``buckets``; repeated runs count again. NULL and empty
    texts have none.
    """
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets are numbered in 16 bits")
    if {"n_words", "buckets"} & set(columns):
        raise ValueError("n_words and buckets are names of results")
    ship(docs.sparkSession)

    def scan(batches) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _portions(whole):
                prefixes = Prefixes.scan(batch.column("text").to_pylist())
                runs = [[b""] * batch.num_rows for _ in range(longest)]
                for n in range(1, longest + 1):
                    crc, counts = prefixes.grams(n)
                    packed = (crc % np.uint32(buckets)).astype("<u2").tobytes()
                    ends = 2 * np.cumsum(counts)
                    runs[n - 1] = [packed[a:b] for a, b in zip((ends - 2 * counts).tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in columns), pa.array(prefixes.n_words), pa.array(map(b"".join, zip(*runs)), pa.binary())],
                    names=[*columns, "n_words", "buckets"],
                )

    read = docs.select(*columns, *([] if "text" in columns else ["text"]))
    found = [T.StructField("n_words", T.LongType()), T.StructField("buckets", T.BinaryType())]
    return read.mapInArrow(scan, T.StructType([*(read.schema[c] for c in columns), *found]))


def bucket_counts(runs: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket stands in a table of ``word_runs``: every task counts its rows, Spark adds the tasks' counts.

    What comes to the driver is one number for each bucket, however many documents there are.
    """

    def count(batches) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in batch.column("buckets"):
                total += np.bincount(np.frombuffer(packed.as_buffer(), "<u2"), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], names=["bucket", "n"])

    summed = runs.select("buckets").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(buckets, np.int64)
    counts[summed.column("bucket").to_numpy()] = summed.column("n").to_numpy()
    return counts


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket, 1000 times the log ratio of its smoothed shares of the target and of the raw corpus, rounded down."""
    b = len(raw)
    up = (target + 1.0) * float(raw.sum() + b)
    down = (raw + 1.0) * float(target.sum() + b)
    return np.floor(1000.0 * np.log(up / down)).astype(np.int64)


def weighed(runs: DataFrame, gain: np.ndarray, columns: list[str]) -> DataFrame:
    """``columns``, n_words, n_features and weight: the mean gain of a row's runs, rounded down (0 without any)."""
    sent = runs.sparkSession.sparkContext.broadcast(gain)

    def weigh(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_features, weights = [], []
            for packed in batch.column("buckets"):
                found = np.frombuffer(packed.as_buffer(), "<u2")
                n_features.append(len(found))
                weights.append(int(sent.value[found].sum()) // max(1, len(found)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in [*columns, "n_words"]), pa.array(n_features, pa.int64()), pa.array(weights, pa.int64())],
                names=[*columns, "n_words", "n_features", "weight"],
            )

    schema = T.StructType([*(runs.schema[c] for c in [*columns, "n_words"]), *(T.StructField(n, T.LongType()) for n in ("n_features", "weight"))])
    return runs.select(*columns, "n_words", "buckets").mapInArrow(weigh, schema)


def _noise(seed: int):
    """A Gumbel number of the document, in thousandths, from a hash of the seed and its id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(
    docs: DataFrame, target: DataFrame, share_percent: int = SHARE_PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED,
    longest: int = LONGEST_RUN, buckets: int = BUCKETS, columns: list[str] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``columns`` (default doc_id), n_words, n_features, weight, score and rank.

    Both tables' texts give counts of word runs by bucket, over all rows. A document's weight is the mean gain of its
    runs, its score the weight and a Gumbel number made from its id, so that the highest scores are a draw without
    replacement in proportion to the weights' exponentials, the same on every run. Of the documents with ``least_words`` words, the
    ``share_percent`` % (rounded down) with the highest scores have a rank, from 1; the others' is NULL.

    Equal scores go by the smaller doc_id, NULL last; rows that are equal in these too are ranked one after the other by their number of runs. A NULL id
    counts as an empty one in the Gumbel number. Empty tables give no rows, an empty target a flat one. Columns that clash with a
    result's name are left out unless asked for, and then an error.
    """
    columns = ["doc_id"] if columns is None else columns
    kept = ["doc_id", *(c for c in columns if c != "doc_id")]
    if {"n_features", "weight", "score", "rank"} & set(kept):
        raise ValueError("n_features, weight, score and rank are names of results")
    runs = written(word_runs(docs, kept, longest, buckets), "runs")
    gain = gains(bucket_counts(runs, buckets), bucket_counts(word_runs(target, [], longest, buckets), buckets))
    scored = written(weighed(runs, gain, kept).withColumn("score", F.col("weight") + _noise(seed)), "scores")
    long_enough = F.col("n_words") >= least_words
    drawn = scored.where(long_enough).count() * share_percent // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").asc()]
    ranked = numbered(in_order(scored.where(long_enough), order, "ranked"), [], "_number")
    rank = F.when(F.col("_number") < drawn, F.col("_number") + 1).alias("rank")
    names = [*columns, "n_words", "n_features", "weight", "score"]
    others = scored.where(~F.coalesce(long_enough, F.lit(False))).select(*names, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*names, rank).unionByName(others)


def drawn_documents(docs: DataFrame, target: DataFrame, **parameters) -> DataFrame:
    """The documents drawn, with their columns."""
    names = docs.columns
    plain = docs.select(*[F.col(f"`{c}`").alias(f"_{i}") if c not in ("doc_id", "text") else F.col(c) for i, c in enumerate(names)])
    found = resample(plain, target, columns=plain.columns, **parameters).where("rank IS NOT NULL")
    return found.select(*[F.col(c).alias(name) for c, name in zip(plain.columns, names)])
