"""The queries of this subpackage: each applies one operator to a whole table, with its production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from claimsift.llm import (
    embeddings, jaccard, language, licenses, mixing, neighbours, packing, resampling, rules, sharding, sql, substrings, tries,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents have no paths; here each is a file below its source and its thousand of ids, or ``_`` without them."""
    part = [F.coalesce(F.expr(c).cast("string"), F.lit("_")) for c in ("source", "doc_id div 1000", "doc_id")]
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.concat_ws("/", *part).alias("path"), "text")
    found = licenses.scan_licenses(docs, keep=("doc_id",))
    return found.select("doc_id", "license", "score", "origin", "license_directory")


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicate_vectors(_table(spark, sf_dir, "embeddings"))


def op6_shard_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(_table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substrings.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, _ = rules.apply_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         "kept", "rule")


def op9_token_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences as they are written, the id rows by their checksums."""
    packed = packing.pack_decreasing(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_bounded(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(_table(spark, sf_dir, "embeddings"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = tries.numbered_turns(_table(spark, sf_dir, "conversations"))
    heads = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    return tries.prefix_trie(*tries.rebuilt_from_heads(turns, heads))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {q.__name__: q for q in (
    op1_mix_sources, op2_license_scan, op3_ngram_jaccard_join, op4_language_id, op5_embedding_near_dedup,
    op6_shard_assignment, op7_substring_dedup, op8_quality_rules, op9_token_matrices, op10_best_fit_packing,
    op11_nearest_neighbours, op12_importance_resampling, op13_conversation_trie, pipeline)}
SQL = {
    "op1_mix_sources": sql.OP1, "op3_ngram_jaccard_join": sql.OP3, "op5_embedding_near_dedup": sql.OP5,
    "op6_shard_assignment": sql.OP6,
    "op7_substring_dedup": sql.OP7, "op12_importance_resampling": sql.OP12, "op13_conversation_trie": sql.OP13,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
