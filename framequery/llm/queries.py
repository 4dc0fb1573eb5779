"""The registered queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, importance, line_dedup, merkle, mixing, packing, pii, quality_classifier, quality_rules, sharding, simhash, sql, token_counts, token_files
from .common import scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_passages(docs, count_col="lines_cut")


#: The permutation's secret; a real run passes its own.
PSEUDONYM_KEY = "registered query"


def op2_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymize(docs, PSEUDONYM_KEY, count_col="n_values")


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op5_multiprobe_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "tokens")
    token_files.write(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.digest(spark, path)


def op7_cotrained_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(_table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(_table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(_table(spark, sf_dir, "documents"), merkle.tampered())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_pii_pseudonyms": op2_pii_pseudonyms,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_multiprobe_neighbours": op5_multiprobe_neighbours,
    "op6_token_files": op6_token_files,
    "op7_cotrained_quality": op7_cotrained_quality,
    "op8_entropy_mix": op8_entropy_mix,
    "op9_token_counts": op9_token_counts,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_histogram_shards": op12_histogram_shards,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE_SQL: dict[str, str] = {
    "op11_importance_resampling": sql.importance_sql(),
    "op12_histogram_shards": sql.shards_sql(),
    "op13_merkle_manifest": sql.manifest_sql(),
}
