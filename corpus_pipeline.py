"""A corpus through five operators: each stage's rows are written as Parquet and read again as the next one's documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from arbograph.llm import line_dedup, pieces, quality, simhash, winnow
from arbograph.llm.batches import saved, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels, scores below 0.3 go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of one word or more that match an earlier line go, and documents of which nothing is left."""
    return line_dedup.dedup_lines(docs, min_words=1)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group linked by five-word shingles: fingerprints at three or fewer differing bits, or a
    Jaccard similarity of 0.8 or more."""
    return simhash.deduplicate(docs, k=5, max_distance=3, similarity=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words in a row of a benchmark item go."""
    return winnow.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def piece_coding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text, and the text decoded from them, beside the columns of documents."""
    return pieces.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_deduplication),
    ("SimHash near-dedup", near_deduplication),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding and decoding", piece_coding),
]

#: The classifier and the fingerprints have no form in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), "stage")
    return docs
