"""Quality of documents: boosted trees over statistics of the whole text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.llm.boost import Forest, fit
from isobar.llm.common import lighten, ship

MOST_LABELLED = 20_000
THRESHOLD = 0.3
HELD_OUT_OF = 5

_CLASS = np.full(256, 7)
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[[ord(c) for c in " \t\r"]] = 3
_CLASS[ord("\n")] = 4
_CLASS[[ord(c) for c in ".,;:'\"()-"]] = 5
_CLASS[128:] = 6

STATISTICS = (
    "log_bytes", "upper", "digits", "blanks", "breaks", "punctuation", "beyond_ascii", "symbols", "entropy", "top_byte",
    "log_words", "word_length", "distinct_words", "line_length", "distinct_lines", "sentence_ends", "commas", "bars",
    "exclamations", "colons", "short_words", "long_words", "capitalised", "repeated_pairs",
)


def statistics(text: str | None) -> list[float]:
    """The numbers of STATISTICS for one text; an empty or NULL text gives zeros."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return [0.0] * len(STATISTICS)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = len(raw)
    kinds = np.bincount(_CLASS, counts, 8) / n
    used = counts[counts > 0] / n
    words = raw.split()
    n_words = max(1, len(words))
    distinct = len(set(words))
    lines = raw.split(b"\n")
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    inked = n - counts[32] - counts[10]
    pairs = len(set(zip(words, words[1:])))
    return [
        np.log1p(n), kinds[1] / max(kinds[0] + kinds[1], 1e-9), kinds[2], kinds[3], kinds[4], kinds[5], kinds[6], kinds[7],
        float(-(used * np.log2(used)).sum()), counts.max() / n,
        np.log1p(len(words)), inked / n_words, distinct / n_words, np.log1p(n / len(lines)), len(set(lines)) / len(lines),
        counts[ord(".")] / n_words, counts[ord(",")] / n_words, counts[ord("|")] / n_words, counts[ord("!")] / n_words,
        counts[ord(":")] / n_words, float((lengths <= 2).sum()) / n_words, float((lengths >= 15).sum()) / n_words,
        sum(map(bytes.istitle, words)) / n_words, 1 - pairs / max(1, n_words - 1) if len(words) > 1 else 0.0,
    ]


def held_out(doc_id) -> F.Column:
    """Rows kept from learning: crc32 of the id as text divides by 5. A NULL id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % HELD_OUT_OF == 0, F.lit(False))


def with_statistics(docs: DataFrame, columns: list[str]) -> DataFrame:
    ship(docs.sparkSession)

    def measure(batches):
        lighten()
        for batch in batches:
            rows = [statistics(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(rows, pa.list_(pa.float64()))], names=[*columns, "statistics"]
            )

    kept = docs.select(*columns, "text")
    schema = T.StructType([*(kept.schema[c] for c in columns), T.StructField("statistics", T.ArrayType(T.DoubleType()))])
    return kept.mapInArrow(measure, schema)


def learn(docs: DataFrame, labels: DataFrame, most_labelled: int = MOST_LABELLED) -> Forest:
    """Fit on labelled documents that are not held out, ``most_labelled`` of them at most (those whose ids hash lowest).

    The bound makes the labels small enough to send to all tasks, and the statistics of the documents they mark small enough to fit here:
    of rows that share a labelled id the one with the least statistics counts, so no more rows are fetched than there are labels.
    Labels other than 0 and 1, and those of unknown documents, are left out; without any every document scores 0.5.
    """
    usable = labels.select(F.col("doc_id").alias("_labelled"), F.col("quality").alias("_quality")).where(
        F.col("_quality").isin(0, 1) & F.col("_labelled").isNotNull() & ~held_out("_labelled")
    )
    sample = usable.orderBy(F.xxhash64("_labelled"), "_labelled", "_quality").limit(most_labelled)
    marked = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_labelled"))
    single = with_statistics(marked, ["doc_id", "_quality"]).groupBy("doc_id", "_quality").agg(F.min("statistics").alias("statistics"))
    rows = single.toArrow().sort_by([("doc_id", "ascending"), ("_quality", "ascending")])
    y = rows.column("_quality").to_numpy().astype(float)
    x = np.array(rows.column("statistics").to_pylist(), float).reshape(len(y), len(STATISTICS))
    return fit(x, y)


def score(docs: DataFrame, forest: Forest, name: str = "score", columns: list[str] | None = None) -> DataFrame:
    """The columns asked for (default: all) and ``name``: how likely the text is of label 1, 0 to 1.

    Every row gets a score from its whole text and nothing else; an empty or NULL text has one too.
    """
    columns = docs.columns if columns is None else columns
    if name in columns:
        raise ValueError(f"there is a column {name} already")
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(forest)
    read = columns if "text" in columns else [*columns, "text"]

    def judge(batches):
        lighten()
        for batch in batches:
            x = np.array([statistics(t) for t in batch.column("text").to_pylist()], float).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(sent.value.probabilities(x))], names=[*columns, name]
            )

    rows = docs.select(*read)
    schema = T.StructType([*(rows.schema[c] for c in columns), T.StructField(name, T.DoubleType())])
    return rows.mapInArrow(judge, schema)
