"""The queries of this subpackage, each over its whole table with production parameters, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import divergence, line_dedup, pieces, quality, rendezvous, secret_scan, simhash, token_files, toxicity, winnow
from .batches import scratch_root, table
from .oracle import ORACLE
from .sampling import id_remainder


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_root(spark)}/tokens-{uuid.uuid4().hex}"
    token_files.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), path)
    return token_files.read_tokens(spark, path)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"), k=3, max_distance=2)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = divergence.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "char_distance", "word_distance")


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnow.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = id_remainder(F.col("doc_id"), 4) == 2
    scores = toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), train=~held_out)
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.find_secrets(table(spark, sf_dir, "documents")))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"), min_words=1)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = id_remainder(F.col("doc_id"), 5) == 0
    scores = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), train=~held_out)
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendezvous.assign_shards(table(spark, sf_dir, "documents"), shards=24)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_token_files, op2_simhash, op3_divergence, op4_pieces, op5_decontamination, op6_toxicity, op7_secrets, op8_line_dedup, op9_quality, op10_sharding)}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
