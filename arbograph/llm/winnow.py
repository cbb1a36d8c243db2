"""Benchmark decontamination by winnowing.

Both sides keep, of every WINDOW - K + 1 consecutive k-gram hashes, the smallest (the last of equals). A window of WINDOW
words is itself such a stretch, so two equal windows keep the same k-gram: every shared span of WINDOW words is found.
The benchmark's fingerprints set bits in a bitmap of fixed size; a document's fingerprint whose bit is set extends to
the windows around it, and those are joined with the benchmark's windows word for word, so the report is exact. Items
of fewer words are one window; for each such length all grams of that length take the place of the fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .batches import columns, free_name, record_batch, saved, small, text_chunks
from .bytewords import Words, gram_hashes, words_of

K, WINDOW = 5, 10
#: log2 of the bits of the benchmark's bitmap: 2 MB, however large the benchmark is.
BITMAP_BITS = 24
_WORD = np.array([0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
_CAND = pa.list_(pa.struct([("at", pa.int32()), ("size", pa.int32()), ("span", pa.string())]))
_DOCS = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("found", _CAND)])
_ITEMS = pa.schema([("item_id", pa.string()), ("size", pa.int32()), ("span", pa.string())])
_BITS = pa.schema([("size", pa.int32()), ("slot", pa.int64())])


def fingerprint_at(w: Words) -> np.ndarray:
    """Places of the words at which a kept k-gram starts."""
    grams = gram_hashes(w.hashes, K)
    n = len(w.hashes) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    low, at = grams[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, WINDOW - K + 1):
        later = grams[j : j + n]
        less = later <= low
        low[less], at[less] = later[less], j
    whole = w.text[:n] == w.text[WINDOW - 1 :]
    kept = np.zeros(len(w.hashes), bool)
    kept[(np.arange(n) + at)[whole]] = True
    return np.flatnonzero(kept)


def _slots(hashes: np.ndarray, size: int) -> np.ndarray:
    return ((hashes + np.uint64(size)) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


def _fingerprints(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, slot in the bitmap) of all fingerprints for windows of ``size`` words."""
    if size == WINDOW:
        at = fingerprint_at(w)
        return at, _slots(gram_hashes(w.hashes, K)[at], size) if len(at) else at
    grams = gram_hashes(w.hashes, size)
    at = np.flatnonzero(w.text[: len(grams)] == w.text[size - 1 :]) if len(grams) else np.zeros(0, np.int64)
    return at, _slots(grams[at], size)


def _windows(w: Words, i: int) -> list[tuple[int, int]]:
    """(place, size) of the windows of text i."""
    first, n = int(w.first[i]), int(w.first[i + 1] - w.first[i])
    return [(first, n)] if 0 < n < WINDOW else [(first + j, WINDOW) for j in range(n - WINDOW + 1)]


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs(doc_id, text), benchmark(item_id, text) -> a row for each row of docs: rid (a number of the row), doc_id,
    n_words, n_hit (words inside any occurrence of a benchmark window), items (sorted strings), n_items, items_sha256,
    contaminated.

    Null texts have no words. An item without an id still hits words but is not listed. Repeated documents each get
    their row, repeated items count once. An empty benchmark leaves every document clean.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches):
            w, ids = words_of(texts, _WORD, hashed=False), part.column("item_id").to_pylist()
            rows = [(ids[i], size, w.span(at, size)) for i in range(len(texts)) for at, size in _windows(w, i)]
            if rows:
                yield record_batch(_ITEMS, *map(list, zip(*rows)))

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_chunks(batches):
            w = words_of(texts, _WORD)
            counts = np.diff(w.first)
            for size in (WINDOW, *sorted({int(n) for n in counts if 0 < n < WINDOW})):
                at, slot = _fingerprints(w, size)
                slot = slot[counts[w.text[at]] == size] if size < WINDOW else slot
                if len(slot):
                    yield record_batch(_BITS, np.full(len(slot), size, np.int32), slot)

    bits = items.select("text").mapInArrow(slots, "size int, slot long")
    bits = saved(bits.groupBy("size", F.expr("slot div 64").alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("bits")), "bitmap")
    sizes = [r.size for r in bits.select("size").distinct().collect()]  # ten at most
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    for r in bits.groupBy("cell").agg(F.bit_or("bits").alias("bits")).toLocalIterator():  # as many rows as cells at most
        bitmap[r.cell] = r.bits
    shared = spark.sparkContext.broadcast(bitmap)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for part, texts in text_chunks(batches):
            w = words_of(texts, _WORD)
            found: list[list[tuple[int, int, str]]] = [[] for _ in texts]
            for size in sizes:
                at, slot = _fingerprints(w, size)
                at = at[(known[slot >> 6] >> (slot & 63)) & 1 == 1]
                if size == WINDOW and len(at):  # all windows around the k-gram that lie in its text
                    near = np.unique((at[:, None] - np.arange(WINDOW - K + 1)).ravel())
                    near = near[(near >= 0) & (near + WINDOW <= len(w.text))]
                    at = near[w.text[near] == w.text[near + WINDOW - 1]]
                for x in at.tolist():
                    i = int(w.text[x])
                    found[i].append((x - int(w.first[i]), size, w.span(x, size)))
            yield record_batch(_DOCS, part.column("rid"), part.column("doc_id"), np.diff(w.first), pa.array([[dict(zip(("at", "size", "span"), c)) for c in f] for f in found], _CAND))

    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = saved(rows.mapInArrow(candidates, "rid long, doc_id long, n_words long, found array<struct<at: int, size: int, span: string>>"), "spans")
    known = items.mapInArrow(spans, "item_id string, size int, span string").distinct()
    hits = rows.select("rid", F.explode("found").alias("f")).select("rid", "f.*").join(known, ["span", "size"])
    hits = hits.groupBy("rid").agg(F.array_sort(F.collect_set("item_id")).alias("items"), F.array_sort(F.collect_set(F.struct("at", "size"))).alias("spans"))
    covered = F.aggregate("spans", F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), lambda a, s: F.struct(F.greatest(a["end"], s["at"] + s["size"]).alias("end"), (a["n"] + F.greatest(F.lit(0), s["at"] + s["size"] - F.greatest(a["end"], s["at"]))).alias("n")), lambda a: a["n"].cast("long"))
    hits = hits.select("rid", "items", covered.alias("n_hit"))
    out = rows.drop("found").join(hits, "rid", "left")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select("rid", "doc_id", "n_words", n_hit.alias("n_hit"), listed.alias("items"), F.size(listed).cast("long").alias("n_items"), F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs without a word inside a benchmark window, each judged by its own text, whatever its doc_id. Texts
    stay in place unless more are contaminated than may be broadcast."""
    own, mark = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))), free_name(docs, "__hit")
    hit = report(docs.select(own.alias("doc_id"), "text"), benchmark).where("contaminated").select(F.col("doc_id").alias(mark)).distinct()
    return docs.join(small(saved(hit, "hits")), own == F.col(mark), "left_anti").select(*columns(docs))
