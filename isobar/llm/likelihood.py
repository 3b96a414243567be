"""Quality rules: plain counts of a text, and how much likelier its words are in trusted documents than in the whole corpus."""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.llm.common import ship

BUCKETS = 1 << 16
PAIR_FACTOR = 1_000_003
#: A text goes if its words are on average this much less likely in trusted documents, in thousandths of a log unit.
LEAST_MEAN = -125
#: Added to how often a bucket stands in trusted documents and to how often it would if they were like all: rare buckets say little.
PSEUDO_COUNT = 10.0
#: As many runs of average likelihood are added to each text, so that a few rare words do not decide over a short one.
PRIOR_RUNS = 20
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
REPEAT_WINDOW = 5
_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_BLANKS = np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8)
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_FACTORS = np.random.Generator(np.random.PCG64(11)).integers(0, 2**63, REPEAT_WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """How many words lie in a window of words that stands in the text at least twice."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    total = np.zeros(n, np.uint64)
    for i, factor in enumerate(_FACTORS):
        total = (total ^ (total >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + hashes[i : n + i] * factor
    _, place, counts = np.unique(total, return_inverse=True, return_counts=True)
    again = counts[place] > 1
    covered = np.zeros(len(words), bool)
    for i in range(window):
        covered[i : n + i] |= again
    return int(covered.sum())


def _buckets(raw: bytes) -> np.ndarray:
    """The buckets of all words (A-Z lower-cased) and pairs of neighbours."""
    words = raw.lower().split()
    crc = np.fromiter(map(crc32, words), np.int64, len(words))
    return np.concatenate([crc, crc[:-1] * PAIR_FACTOR + crc[1:]]) % BUCKETS


def _counts(raw: bytes) -> tuple[int, ...]:
    """The numbers of _COUNTS for one text."""
    words = raw.split()
    kinds = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    points = len(raw) - int(kinds[0x80:0xC0].sum())
    lines = [line for line in raw.split(b"\n") if line and not line.isspace()]
    return (
        len(words), points - int(kinds[_BLANKS].sum()), int(kinds[_SYMBOLS].sum()), len(lines) - len(set(lines)), _repeated_words(words),
    )


def _bytes(text: pa.Scalar) -> bytes:
    return text.as_buffer().to_pybytes() if text.is_valid else b""


def gains(raw: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Of each bucket, 1000 times the log ratio of its shares of the trusted and of all runs, rounded down.

    Both multinomials are smoothed at the size of the trusted one, so that neither is flatter than the other. Without trusted
    documents all gains are 0.
    """
    expected = raw.astype(float) * float(good.sum()) / max(1.0, float(raw.sum()))
    return np.floor(1000.0 * np.log((good + PSEUDO_COUNT) / (expected + PSEUDO_COUNT))).astype(np.int64)


def corpus_counts(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """How often each bucket stands in all documents, and in trusted ones.

    Buckets, two bytes for each word and pair, meet the trusted ids in a join; each task then counts its rows, and one number for each
    bucket comes to the driver.
    """
    ship(docs.sparkSession)

    def scan(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [_buckets(_bytes(t)).astype("<u2").tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(packed, pa.binary())], names=["doc_id", "buckets"])

    def count(batches) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for packed, trusted in zip(batch.column("buckets"), batch.column("trusted").to_pylist()):
                found = np.bincount(np.frombuffer(packed.as_buffer(), "<u2"), minlength=BUCKETS)
                total[0] += found
                if trusted:
                    total[1] += found
        some = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *map(pa.array, total[:, some])], names=["bucket", "raw", "good"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    runs = docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {kind}, buckets binary")
    # A merge join at every size: the labels have no bound, and AQE splits an id that many rows share.
    marked = runs.join(trusted_ids(labels).hint("merge"), F.col("doc_id") == F.col("_trusted"), "left")
    counts = marked.select("buckets", F.col("_trusted").isNotNull().alias("trusted")).mapInArrow(count, "bucket int, raw long, good long")
    summed = counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")).toArrow()
    made = np.zeros((2, BUCKETS), np.int64)
    made[:, summed.column("bucket").to_numpy()] = [summed.column(c).to_numpy() for c in ("raw", "good")]
    return made[0], made[1]


def trusted_ids(labels: DataFrame) -> DataFrame:
    """doc_ids that some label calls good and none bad; labels other than 0 and 1 say nothing."""
    said = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    good = said.groupBy("doc_id").agg(F.min("quality").alias("_least")).where("_least = 1")
    return good.select(F.col("doc_id").alias("_trusted"))


def apply_rules(docs: DataFrame, labels: DataFrame, columns: list[str] | None = None, least_mean: int = LEAST_MEAN) -> DataFrame:
    """One row per row of ``docs``: ``columns`` (default doc_id), the counts, base_failed, ratio and kept.

    Words are split at ASCII white space. Base rules: fewer than LEAST_WORDS words, or more than MOST_REPEATED_PERCENT % of
    them in windows of REPEAT_WINDOW words that the text holds more than once. The others are judged by ``ratio``: words and pairs of words
    (A-Z lower-cased) fall into BUCKETS buckets, each with the gain of ``gains``; ratio is the sum of a text's gains over its number of
    runs and PRIOR_RUNS, rounded down. A text stays from ``least_mean`` on. No chance is in it: a rerun gives the same for every document.

    Both multinomials count all rows: the corpus is ``docs``, the trusted ones its rows whose id the labels call good. Without any
    no text is worse than another, and only the base rules decide. Repeated rows count again; a NULL id is never trusted. An empty
    table gives no rows.
    """
    columns = ["doc_id"] if columns is None else columns
    clash = {*_COUNTS, "base_failed", "ratio", "kept"} & set(columns)
    if clash:
        raise ValueError(f"{sorted(clash)} are names of results")
    gain = gains(*corpus_counts(docs, labels))
    sent = docs.sparkSession.sparkContext.broadcast(gain)

    def judge(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                raw = _bytes(text)
                found = _buckets(raw)
                rows.append((*_counts(raw), int(sent.value[found].sum()) // (len(found) + PRIOR_RUNS)))
            cells = list(zip(*rows)) or [[]] * (len(_COUNTS) + 1)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), *(pa.array(c, pa.int64()) for c in cells)], names=[*columns, *_COUNTS, "ratio"]
            )

    read = docs.select(*columns, *([] if "text" in columns else ["text"]))
    schema = T.StructType([*(read.schema[c] for c in columns), *(T.StructField(n, T.LongType()) for n in (*_COUNTS, "ratio"))])
    judged = read.mapInArrow(judge, schema)
    few = F.col("n_words") < LEAST_WORDS
    repeated = 100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    return judged.withColumn("base_failed", few | repeated).withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= least_mean))
