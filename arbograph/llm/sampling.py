"""A bounded sample of labelled rows, its features gathered for training on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


#: UTF-8 bytes of a text to learn from at most; longer ones are left out of the sample (and scored whole like all others).
LONGEST = 1 << 17


def id_remainder(doc_id: Column, folds: int) -> Column:
    """crc32 of doc_id as text, modulo folds; null counts as ''."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, most: int) -> DataFrame:
    """(doc_id, text, y): at most ``most`` documents with a label for which ``train`` holds, the same ones each time.

    Rows without an id or a label of 0 or 1, and texts of more than LONGEST bytes, are left out; of repeated labels of an
    id the largest counts, of its texts the first in order. The ids, ``most`` at most, are chosen first, so only their
    texts are moved: ``most`` rows and ``most`` * LONGEST bytes at most.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    known = known.groupBy("doc_id").agg(F.max("y").alias("y")).where(train)
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = texts.where(F.octet_length("text") <= LONGEST).join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("doc_id", "text", "y")


def best_cut(score, y, weight: float = 1.0) -> float:
    """The cut between two scores at which F1 of the rarer label is best; 0.5 where a label is missing."""
    import numpy as np

    score, y = np.asarray(score, float), np.asarray(y, bool)
    if not len(y) or y.all() or not y.any():
        return 0.5
    rare_high = y.mean() <= 0.5
    order = np.argsort(-score if rare_high else score, kind="stable")
    s, hit = score[order], (y if rare_high else ~y)[order]
    tp = np.cumsum(hit)
    f1 = 2 * tp / (np.arange(1, len(s) + 1) + hit.sum())
    f1[:-1][s[:-1] == s[1:]] = -1
    i = int(np.argmax(f1))
    return float((s[i] + s[min(i + 1, len(s) - 1)]) / 2)


def at_cut(score, cut: float, to: float = 0.3):
    """Scores moved on the logit scale so that ``cut`` lands on ``to``; the order stays."""
    import numpy as np

    logit = lambda p: np.log(p / (1 - p))
    z = logit(np.clip(score, 1e-9, 1 - 1e-9)) + logit(to) - logit(min(max(cut, 1e-6), 1 - 1e-6))
    return 1 / (1 + np.exp(-z))
