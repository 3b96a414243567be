"""The queries of this subpackage, over whole tables with production parameters, and SQL for them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.llm import expected, fm_index, likelihood, line_dedup, merkle, minhash, mixing, pii, quality, resampling, ring, token_files, trie_dedup
from isobar.llm.common import documents, shared_folder

TOKENIZER = "byte_bpe_50k.json"
SEPARATOR = 50256  # <|endoftext|>
END_ID = 2
SHARDS = 8


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_dedup.exact_dedup(documents(spark, sf_dir), keep="largest")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.dedup_lines(documents(spark, sf_dir))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    forest = quality.learn(docs, _table(spark, sf_dir, "labels"))
    scored = quality.score(docs, forest, "score", ["doc_id"])
    return scored.select(
        "doc_id", quality.held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_personal_data(documents(spark, sf_dir)))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = ring.assign(documents(spark, sf_dir), SHARDS, law="rows")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_counts(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER), SEPARATOR)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fm_index.find_items(documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    names = F.concat_ws(",", F.array_sort(F.transform("_items", lambda i: i.cast("string"))))
    return found.select(
        "doc_id", F.col("_n_words").alias("n_words"), n_hit.alias("n_hit"), F.size("_items").cast("long").alias("n_items"),
        F.sha2(names.cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "sequences")
    files = token_files.write_sequences(documents(spark, sf_dir), folder, public_tokenizers.path(TOKENIZER), END_ID)
    return token_files.documents_in_sequences(files, folder)


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = likelihood.apply_rules(documents(spark, sf_dir), _table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "ratio", "kept")


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resample(documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = [F.col(c) for c in merkle.COLUMNS]
    changed = [F.replace("text", F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in merkle.COLUMNS]
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(even, merkle.leaf_of(changed)).otherwise(merkle.leaf_of(plain))
    return merkle.prove(merkle.build(documents(spark, sf_dir), carried={"tampered": tampered}), claimed="tampered")


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_dedup": op1_exact_dedup,
        "op2_line_dedup": op2_line_dedup,
        "op3_quality": op3_quality,
        "op4_personal_data": op4_personal_data,
        "op5_mixing": op5_mixing,
        "op6_sharding": op6_sharding,
        "op7_token_counts": op7_token_counts,
        "op8_decontamination": op8_decontamination,
        "op9_near_duplicates": op9_near_duplicates,
        "op10_token_files": op10_token_files,
        "op11_quality_rules": op11_quality_rules,
        "op12_resampling": op12_resampling,
        "op13_manifest": op13_manifest,
    }


def llm_sql() -> dict[str, str]:
    """SQL where there is any; the other queries are tested against brute force, round trips and held-out labels."""
    return {
        "op1_exact_dedup": expected.EXACT,
        "op2_line_dedup": expected.LINES,
        "op8_decontamination": expected.PHRASES,
        "op9_near_duplicates": expected.NEAR,
        "op11_quality_rules": expected.RULES,
        "op12_resampling": expected.RESAMPLING,
        "op13_manifest": expected.MANIFEST,
    }
