"""From documents to token files: quality, near duplicates, benchmark passages, mixing, ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. ``run`` writes what a
stage returns to the shared folder and reads it again for the next one, so a stage never runs twice and a lost executor costs
no earlier stage.

NULL and empty texts go through all stages by the rules of the operators; rows without a doc_id are never removed as
duplicates; rows that share a doc_id are removed as duplicates together and mixed each by itself. Other columns are carried along, whatever their
names. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.llm import fm_index, minhash, mixing, quality, token_files
from isobar.llm.common import discard, documents, shared_folder, written
from isobar.llm.registered import END_ID, TOKENIZER

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Near copies of the corpus share 80 % of their five-word shingles; op9's three words and 85 % hold for that query alone.
NEAR_WORDS = 5
NEAR_PERCENT = 80
#: 48 bands of 4 miss two texts at exactly 80 % about once in 1e11; 32 bands of 6 would about six times in 100,000.
NEAR_ROWS_PER_BAND = 4


def _unused(docs: DataFrame, name: str) -> str:
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = f"_{name}"
    return name


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for label 1."""
    forest = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    name = _unused(docs, "_quality_score")
    scored = quality.score(docs, forest, name)
    return scored.where(F.col(name) >= quality.THRESHOLD).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, the one with the smallest doc_id."""
    found = minhash.near_duplicates(docs, length=NEAR_WORDS, percent=NEAR_PERCENT, rows=NEAR_ROWS_PER_BAND)
    dropped = found.where("NOT kept").select(F.col("doc_id").alias("_dropped")).distinct()
    return docs.join(dropped, docs["doc_id"] == dropped["_dropped"], "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a phrase of the benchmark; one with a phrase goes as a whole."""
    names = tuple(_unused(docs, n) for n in ("_n_words", "_spans", "_items"))
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = fm_index.find_items(docs, benchmark, columns=docs.columns, names=names)
    return found.where(F.size(names[1]) == 0).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, whole: the document at a source's cut is not shortened."""
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Arrow files of token ids; what they hold of each document, read back from them."""
    folder = shared_folder(spark, "corpus")
    files = token_files.write_sequences(docs, folder, public_tokenizers.path(TOKENIZER), END_ID)
    return token_files.documents_in_sequences(files, folder)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", write_tokens),
]

#: Trees, near-duplicate components and a tokenizer are not SQL; tests hold each stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for number, (name, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, written(stage(spark, docs, sf_dir), name.split()[0].lower(), "zstd")
        if number:
            discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
