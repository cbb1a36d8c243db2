"""Quality classifier: hashed word and character n-gram vectors averaged over the document, softmax, trained in numpy.

A document's features are its words and the byte n-grams inside its words (white space counts as a character at their
edges), each hashed into a table of vectors. The softmax of two labels over the mean vector needs only the difference
of their weights, so a trained model scores with one number for each feature: the vector times that difference.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .batches import free_name, mapped, record_batch, release, text_chunks
from .bytewords import mixed, words_of
from .sampling import at_cut, best_cut, labelled_sample

WORD_BITS, GRAM_BITS, GRAMS = 16, 16, (3, 4)
DIM, EPOCHS, RATE = 10, 6, 0.5
#: Most labelled documents that the training takes.
SAMPLE = 2000
_WORD = np.array([not (b == 0x20 or 0x09 <= b <= 0x0D) for b in range(256)])
_FEATURES = pa.schema([("doc_id", pa.int64()), ("y", pa.int32()), ("at", pa.list_(pa.int32())), ("share", pa.list_(pa.float32()))])


def hashed(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(feature, text) of every word, of every two words in a row, then of every n-gram of each size.

    Two words are hashed by the difference of their hashes, so that any word said twice is one and the same feature.
    """
    w = words_of(texts, _WORD, lower=False)
    yield (w.hashes >> np.uint64(64 - WORD_BITS)).astype(np.int32), w.text
    pairs = np.flatnonzero(w.text[1:] == w.text[:-1])
    yield (mixed(w.hashes[pairs + 1] - w.hashes[pairs]) >> np.uint64(64 - WORD_BITS)).astype(np.int32), w.text[pairs]
    codes = np.frombuffer(w.data, np.uint8)
    inside = _WORD[codes]
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(w.begins))
    for n in GRAMS:
        m = len(codes) - n + 1
        if m <= 0:
            continue
        h = np.full(m, n, np.uint32)
        for j in range(n):
            h = h * np.uint32(0x01000193) + codes[j : j + m] + np.uint32(1)
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        whole = np.ones(m, bool)
        for j in range(1, n - 1):
            whole &= inside[j : j + m]
        whole &= inside[:m] | inside[n - 1 :]
        yield ((h >> np.uint32(32 - GRAM_BITS)).astype(np.int32) + (1 << WORD_BITS))[whole], owner[:m][whole]


def _sparse(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of a text, and the share of each."""
    found = [f for f, _ in hashed([text])]
    at, counts = np.unique(np.concatenate(found), return_counts=True)
    return at.astype(np.int32), (counts / max(1, counts.sum())).astype(np.float32)


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 7) -> tuple[np.ndarray, float, float]:
    """(a number for each feature, bias, cut) from rows of (features, shares, label 0 or 1).

    Every fifth row is kept aside to place the cut. With no rows, or one label alone, every score is that label's share.
    """
    rng = np.random.default_rng(seed)
    y = np.array([r[2] for r in rows], float)
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return np.zeros((1 << WORD_BITS) + (1 << GRAM_BITS), np.float32), float(np.log(share / (1 - share))), 0.5
    vectors = rng.uniform(-0.1, 0.1, ((1 << WORD_BITS) + (1 << GRAM_BITS), DIM)).astype(np.float32)
    weights, bias = rng.normal(0, 0.1, (DIM, 2)).astype(np.float32), np.zeros(2, np.float32)
    train = [i for i in range(len(rows)) if i % 5] or [0]
    steps, step = EPOCHS * len(train), 0
    scale = 100.0  # means of many small vectors are small
    for _ in range(EPOCHS):
        for i in rng.permutation(train):
            at, share, label = rows[i]
            rate = RATE * (1 - step / steps)
            step += 1
            mean = share @ vectors[at] * scale if len(at) else np.zeros(DIM, np.float32)
            z = mean @ weights + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            back = weights @ p
            weights -= rate * 0.1 * np.outer(mean, p)
            bias -= rate * 0.1 * p
            if len(at):
                vectors[at] -= np.float32(rate * scale * 0.1) * share[:, None] * back
    side = weights[:, 1] - weights[:, 0]
    number, offset = vectors @ side * scale, float(bias[1] - bias[0])
    aside = [i for i in range(len(rows)) if i % 5 == 0]
    scores = [1 / (1 + np.exp(-(float(rows[i][1] @ number[rows[i][0]]) + offset))) for i in aside]
    return number.astype(np.float32), offset, best_cut(scores, y[aside])


def scored(docs: DataFrame, labels: DataFrame, column: str, train: Column | None = None, sample: int = SAMPLE) -> DataFrame:
    """docs and a double column of that name: the score of each row's text, as ``classify`` says."""
    spark = docs.sparkSession

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches):
            found = [_sparse(t) for t in texts]
            yield record_batch(_FEATURES, part.column("doc_id"), part.column("y"), pa.array([a for a, _ in found], pa.list_(pa.int32())), pa.array([s for _, s in found], pa.list_(pa.float32())))

    rows = labelled_sample(docs, labels, "quality", F.lit(True) if train is None else train, sample).mapInArrow(gather, "doc_id long, y int, at array<int>, share array<float>").toArrow().sort_by("doc_id")
    at, share = (rows[c].combine_chunks() for c in ("at", "share"))
    ends = at.offsets.to_numpy()
    at, share = at.values.to_numpy(), share.values.to_numpy()
    number, offset, cut = fit([(at[s:e], share[s:e], y) for s, e, y in zip(ends, ends[1:], rows["y"].to_pylist())])
    del rows, at, share
    release(spark)
    model = spark.sparkContext.broadcast((number, offset, cut))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, offset, cut = model.value
        for part, texts in text_chunks(batches):
            total, count = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
            for feature, text in hashed(texts):
                total += np.bincount(text, number[feature], len(texts))
                count += np.bincount(text, minlength=len(texts))
            score = at_cut(1 / (1 + np.exp(-(total / np.maximum(count, 1) + offset))), cut)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score)], names=[*part.schema.names, column])

    return mapped(docs, run, docs.select("*", F.lit(0.0).alias(column)).schema)


def classify(docs: DataFrame, labels: DataFrame, train: Column | None = None, sample: int = SAMPLE) -> DataFrame:
    """docs(doc_id, text), labels(doc_id, quality) -> (doc_id, score): a row for each row of docs.

    ``train`` says by doc_id which labelled rows may be learned from (all, if not given). Scores use the text alone; null
    and empty texts get the score of no features. The model is a table of fixed size, sent to the executors.
    """
    return scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), labels, "score", train, sample).select("doc_id", "score")


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.3, sample: int = SAMPLE) -> DataFrame:
    """The rows of docs whose text scores at least ``least``."""
    score = free_name(docs, "__score")
    return scored(docs, labels, score, sample=sample).where(F.col(score) >= least).drop(score)
