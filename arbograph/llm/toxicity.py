"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word's input is its hashed vector beside the mean of its hashed character n-gram vectors. All windows of WINDOW words,
each overlapping the next by half, pass the network; attention pools its states to one logit for each window. A document
is toxic unless none of its windows is: its score is 1 - prod(1 - p) over the windows, and that is what is trained.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .batches import record_batch, text_chunks
from .bytewords import words_of
from .sampling import at_cut, best_cut, labelled_sample

WINDOW, STRIDE, HIDDEN = 24, 12, 8
WORD_BITS, GRAM_BITS, GRAMS = 14, 15, (4, 6)
WORD_DIM, GRAM_DIM = 6, 8
EPOCHS, RATE, BATCH = 8, 0.01, 1024
#: Small samples are passed more often, up to about so many steps.
LEAST_STEPS = 150
#: Most labelled documents that the training takes.
SAMPLE = 4000
_WORD = np.array([0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
_SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
_TEXTS = pa.schema([("doc_id", pa.int64()), ("y", pa.int32()), ("text", pa.string())])


@dataclass
class Tokens:
    word: np.ndarray  # hashed word of each distinct word
    gram: np.ndarray  # hashed n-grams of the distinct words, one word after the other
    gram_word: np.ndarray  # the distinct word of each n-gram
    ids: np.ndarray  # the distinct word at each place
    counts: np.ndarray  # words of each text

    def mean_grams(self, table: np.ndarray) -> np.ndarray:
        """The mean of a table's rows over the n-grams of each distinct word."""
        n = np.maximum(np.bincount(self.gram_word, minlength=len(self.word)), 1)[:, None]
        sums = np.stack([np.bincount(self.gram_word, table[:, k][self.gram], len(self.word)) for k in range(table.shape[1])], axis=1)
        return (sums / n).astype(np.float32)


def tokens(texts: list[str]) -> Tokens:
    w = words_of([t.lower() for t in texts], _WORD)
    distinct, first, ids = np.unique(w.hashes, return_index=True, return_inverse=True)
    data = b" " + b"".join(w.data[s:e] + b" " for s, e in zip(w.starts[first].tolist(), w.ends[first].tolist()))
    codes = np.frombuffer(data, np.uint8)
    blank = codes == 32
    owner = np.cumsum(blank) - 1  # a blank counts to the word behind it
    grams, owners = [], []
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
            whole &= ~blank[j : j + m]
        grams.append((h >> np.uint32(32 - GRAM_BITS)).astype(np.int32)[whole])
        owners.append(owner[:m][whole])
    empty = np.zeros(0, np.int64)
    return Tokens((distinct >> np.uint64(64 - WORD_BITS)).astype(np.int64), np.concatenate([empty, *grams]), np.concatenate([empty, *owners]), ids, np.diff(w.first))


def windows(counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places of the words, text) of all windows, for each length; a text of fewer words than WINDOW is one window."""
    begins = np.cumsum(counts) - counts
    long = np.flatnonzero(counts >= WINDOW)
    if len(long):
        n = (counts[long] - WINDOW + STRIDE - 1) // STRIDE + 1
        text = np.repeat(long, n)
        at = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * STRIDE
        at = np.minimum(at, counts[text] - WINDOW) + begins[text]
        yield at[:, None] + np.arange(WINDOW), text
    for size in range(1, WINDOW):
        text = np.flatnonzero(counts == size)
        if len(text):
            yield begins[text][:, None] + np.arange(size), text


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Parameters, and the passes over a batch of windows of equal length."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        init = lambda *shape: (rng.normal(0, 1, shape) / np.sqrt(shape[0])).astype(np.float32)
        d = WORD_DIM + GRAM_DIM
        self.p = {"words": init(1 << WORD_BITS, WORD_DIM) * 8, "grams": init(1 << GRAM_BITS, GRAM_DIM) * 8, "attend": init(2 * HIDDEN), "out": init(2 * HIDDEN), "bias": np.full(1, -4, np.float32)}
        for side in "fb":
            self.p |= {f"in_{side}": init(d, 3 * HIDDEN), f"on_{side}": init(HIDDEN, 3 * HIDDEN), f"gate_{side}": np.zeros(3 * HIDDEN, np.float32)}
        self.cut = 0.5

    def inputs(self, t: Tokens) -> np.ndarray:
        return np.concatenate([self.p["words"][t.word], t.mean_grams(self.p["grams"])], axis=1)

    def forward(self, x: np.ndarray, ids: np.ndarray, keep: bool = False):
        """Logits of windows of distinct words (ids: windows by places), with what backward needs."""
        p, (b, n) = self.p, ids.shape
        states, kept = np.empty((n, b, 2 * HIDDEN), np.float32), {}
        for side, order in (("f", range(n)), ("b", range(n - 1, -1, -1))):
            given = x @ p[f"in_{side}"] + p[f"gate_{side}"]
            h, steps, own = np.zeros((b, HIDDEN), np.float32), [], slice(0, HIDDEN) if side == "f" else slice(HIDDEN, None)
            for t in order:
                g, a = given[ids[:, t]], h @ p[f"on_{side}"]
                gates = _sigmoid(g[:, : 2 * HIDDEN] + a[:, : 2 * HIDDEN])
                z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
                new = np.tanh(g[:, 2 * HIDDEN :] + r * a[:, 2 * HIDDEN :])
                if keep:
                    steps.append((t, h, z, r, new, a[:, 2 * HIDDEN :]))
                h = new + z * (h - new)
                states[t, :, own] = h
            kept[side] = steps
        e = states @ p["attend"]
        e = np.exp(e - e.max(axis=0))
        e /= e.sum(axis=0)
        pooled = np.einsum("nb,nbh->bh", e, states)
        return pooled @ p["out"] + p["bias"][0], (x, ids, states, kept, e, pooled)

    def backward(self, dz: np.ndarray, cache, t: Tokens, grads: dict[str, np.ndarray]) -> None:
        p, (x, ids, states, kept, e, pooled) = self.p, cache
        grads["bias"] += dz.sum()
        grads["out"] += dz @ pooled
        d_pooled = dz[:, None] * p["out"]
        d_e = np.einsum("bh,nbh->nb", d_pooled, states)
        d_e = e * (d_e - (e * d_e).sum(axis=0))
        grads["attend"] += np.einsum("nb,nbh->h", d_e, states)
        d_states = e[:, :, None] * d_pooled + d_e[:, :, None] * p["attend"]
        dx = np.zeros_like(x)
        for side, own in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None))):
            dh, d_given = np.zeros((len(dz), HIDDEN), np.float32), np.zeros((len(x), 3 * HIDDEN), np.float32)
            flat_ids, flat_g = [], []
            for at, h, z, r, new, a in reversed(kept[side]):
                dh = dh + d_states[at, :, own]
                d_new = dh * (1 - z) * (1 - new * new)
                d_z = dh * (h - new) * z * (1 - z)
                d_r = d_new * a * r * (1 - r)
                d_a = np.concatenate([d_z, d_r, d_new * r], axis=1)
                grads[f"on_{side}"] += h.T @ d_a
                flat_ids.append(ids[:, at])
                flat_g.append(np.concatenate([d_z, d_r, d_new], axis=1))
                dh = dh * z + d_a @ p[f"on_{side}"].T
            all_ids, all_g = np.concatenate(flat_ids), np.concatenate(flat_g)
            for k in range(3 * HIDDEN):
                d_given[:, k] = np.bincount(all_ids, all_g[:, k], len(x))
            grads[f"in_{side}"] += x.T @ d_given
            grads[f"gate_{side}"] += d_given.sum(axis=0)
            dx += d_given @ p[f"in_{side}"].T
        np.add.at(grads["words"], t.word, dx[:, :WORD_DIM])
        share = (dx[:, WORD_DIM:] / np.maximum(np.bincount(t.gram_word, minlength=len(x)), 1)[:, None])[t.gram_word]
        for k in range(GRAM_DIM):
            grads["grams"][:, k] += np.bincount(t.gram, share[:, k], 1 << GRAM_BITS)

    def score(self, texts: list[str]) -> np.ndarray:
        """1 - prod(1 - p) over all windows of each text; a text without words has 0."""
        t = tokens(texts)
        x, total = self.inputs(t), np.zeros(len(texts))
        for places, text in windows(t.counts):
            for at in range(0, len(text), 4096):
                z, _ = self.forward(x, t.ids[places[at : at + 4096]])
                total += np.bincount(text[at : at + 4096], np.logaddexp(0, z), len(texts))
        return -np.expm1(-total)


def _log_odds(seen: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How much more often a feature is in the texts of label 1, as a damped logarithm; seen: texts by label and feature."""
    n = np.bincount(y, minlength=2) + 2
    return np.clip(np.log((seen[1] + 1) / n[1]) - np.log((seen[0] + 1) / n[0]), -2, 4).astype(np.float32)


def fit(texts: list[str], y: list[int], seed: int = 11) -> Network:
    """Train on whole texts with labels 0 and 1; every fifth one is kept aside to place the cut.

    One number of each vector starts from the feature's log odds. With a label missing, nothing is trained.
    """
    net, labels = Network(seed), np.array(y, np.int64)
    if not len(labels) or labels.min() == labels.max():
        return net
    aside = np.arange(len(labels)) % 5 == 0
    train = np.flatnonzero(~aside) if (~aside).any() else np.arange(len(labels))
    seen, size = {"words": np.zeros((2, 1 << WORD_BITS)), "grams": np.zeros((2, 1 << GRAM_BITS))}, {}
    for i in train.tolist():
        t = tokens([texts[i]])
        size[i] = max(1, int(t.counts[0]) // STRIDE)
        for k, f in (("words", t.word), ("grams", t.gram)):
            seen[k][labels[i], np.unique(f)] += 1
    for k, v in seen.items():
        net.p[k][:, 0] = _log_odds(v, labels[train])
    rng, mean, square, step = np.random.default_rng(seed), {k: np.zeros_like(v) for k, v in net.p.items()}, {k: np.zeros_like(v) for k, v in net.p.items()}, 0
    rare = 0.5 * len(train) / max(1, labels[train].sum())
    plans = []
    for _ in range(max(EPOCHS, min(100, -(-LEAST_STEPS * BATCH // sum(size.values()))))):
        batch, n = [], 0
        for i in rng.permutation(train).tolist():
            batch.append(i)
            n += size[i]
            if n >= BATCH:
                plans.append(batch)
                batch, n = [], 0
        plans += [batch] if batch else []
    for batch in plans:
        t = tokens([texts[i] for i in batch])
        x, parts, total = net.inputs(t), [], np.zeros(len(batch))
        for places, text in windows(t.counts):
            z, cache = net.forward(x, t.ids[places], keep=True)
            total += np.bincount(text, np.logaddexp(0, z), len(batch))
            parts.append((z, cache, text))
        own = labels[batch]
        slope = np.where(own == 1, -min(rare, 4.0) / np.maximum(np.expm1(np.minimum(total, 30)), 0.05), 1.0) / len(batch)
        grads = {k: np.zeros_like(v) for k, v in net.p.items()}
        for z, cache, text in parts:
            net.backward((slope[text] * _sigmoid(z)).astype(np.float32), cache, t, grads)
        step += 1
        rate = RATE * (1 - step / (len(plans) + 1))
        for k, g in grads.items():
            mean[k] += 0.1 * (g - mean[k])
            square[k] += 0.001 * (g * g - square[k])
            net.p[k] -= rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-6)
    kept = np.flatnonzero(aside)
    scores = np.concatenate([net.score([texts[i] for i in kept[at : at + 100]]) for at in range(0, len(kept), 100)])
    net.cut = best_cut(scores, labels[kept])
    return net


def classify(docs: DataFrame, labels: DataFrame, train: Column | None = None, sample: int = SAMPLE) -> DataFrame:
    """docs(doc_id, text), labels(doc_id, toxic) -> (doc_id, score): a row for each row of docs.

    ``train`` says by doc_id which labelled rows may be learned from (all, if not given). Scores use the text alone; null
    and empty texts score the least. The network has a fixed size and is sent to the executors.
    """
    spark = docs.sparkSession
    rows = labelled_sample(docs, labels, "toxic", F.lit(True) if train is None else train, sample).toArrow().sort_by("doc_id")
    net = fit(rows["text"].to_pylist(), rows["y"].to_pylist())
    model = spark.sparkContext.broadcast((net.p, net.cut))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network()
        net.p, net.cut = model.value
        for part, texts in text_chunks(batches):
            yield record_batch(_SCORES, part.column("doc_id"), at_cut(net.score(texts), net.cut))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
