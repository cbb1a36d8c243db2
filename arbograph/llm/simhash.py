"""SimHash near-duplicate detection by pigeonhole blocks.

Fingerprints (64 bits) that differ in at most d bits agree in at least two of d + 2 blocks of bits. Each distinct
fingerprint is keyed by every pair of blocks; fingerprints that share a key are compared by Hamming distance. A key
with more than ``bucket`` members is not compared at once: its members are keyed again by pairs of blocks of their
remaining bits, until a bucket is small or so few bits are free that it cannot hold more members. So no link is lost,
no bucket is unbounded, and each compared bucket sends on a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from . import shingles
from .batches import columns, free_name, record_batch, saved, small, text_chunks
from .components import connected_components

SEED = 42
_FP = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
_ROWS = pa.schema([("doc_id", pa.int64()), ("node", pa.int64()), ("fp", pa.int64()), ("key", pa.int64()), ("n", pa.int32()), ("prefix", pa.list_(pa.int64()))])
_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def fingerprint(text: str, k: int) -> int:
    """64 bits over the k-word shingles of text, repeats included: a bit is set if over half the shingle hashes have it.

    A-Z is lower-cased, words are separated by ASCII white space; fewer words than k make one shingle, none give 0.
    """
    norm = b" ".join(text.encode("utf-8", "surrogatepass").lower().split())
    if not norm:
        return 0
    spaces = np.flatnonzero(np.frombuffer(norm, np.uint8) == 32)
    if len(spaces) + 1 < k:
        return xxhash.xxh64_intdigest(norm, SEED)
    starts, ends = [0, *(spaces + 1).tolist()], [*spaces.tolist(), len(norm)]
    digest, seed, total, n = xxhash.xxh64_intdigest, SEED, np.zeros(64, np.int64), len(starts) - k + 1
    for at in range(0, n, 1 << 15):
        to = min(n, at + (1 << 15))
        h = np.fromiter((digest(norm[s:e], seed) for s, e in zip(starts[at:to], ends[at + k - 1 : to + k - 1])), np.uint64, to - at)
        total += np.add.reduce(np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"), axis=0, dtype=np.uint32)
    return int(np.packbits(2 * total > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, k: int = 5) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, fp long). A null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches):
            yield record_batch(_FP, part.column("doc_id"), np.array([fingerprint(t, k) for t in texts], np.uint64).view(np.int64))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _split(free: list[int], d: int) -> list[int]:
    """Masks of all pairs of d + 2 blocks of the free bits."""
    blocks = [sum(1 << free[i] for i in part) for part in np.array_split(np.arange(len(free)), d + 2)]
    return [x | y for x, y in combinations(blocks, 2)]


def local_forest(fps: np.ndarray, ids: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray]:
    """(id, smallest id of its component) within one bucket, for ids that are not the smallest themselves."""
    order = np.argsort(ids, kind="stable")
    fps, ids = fps[order].view(np.uint64), ids[order]  # bits of negative numbers would be counted without their sign
    label, n = np.arange(len(fps)), len(fps)
    step = max(1, (1 << 21) // n)
    ends = [np.nonzero(np.bitwise_count(fps[at : at + step, None] ^ fps[None, :]) <= d) for at in range(0, n, step)]
    a, b = np.concatenate([x + at for (x, _), at in zip(ends, range(0, n, step))]), np.concatenate([y for _, y in ends])
    while True:
        low = label.copy()
        np.minimum.at(low, a, label[b])
        low = low[low]
        if (low == label).all():
            break
        label = low
    moved = np.flatnonzero(label != np.arange(n))
    return ids[moved], ids[label[moved]]


def link_edges(nodes: DataFrame, d: int = 2, bucket: int = 1024, last_bits: int = 10) -> DataFrame:
    """nodes(fp long, id long; fp distinct) -> (a, b): edges whose components are those of all pairs at d or fewer differing bits."""
    if d < 1:
        raise ValueError("equal fingerprints are already one node; max_distance starts at 1")

    def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [local_forest(*(np.array([m[f] for m in row], np.int64) for f in ("fp", "id")), d) for row in batch.column("members").to_pylist()]
            if found:
                yield record_batch(_EDGES, *(np.concatenate([x[i] for x in found]) for i in (0, 1)))

    masks = _split(list(range(64)), d)
    rows = nodes.select("fp", "id", F.explode(F.array(*(F.struct(F.lit(_signed(m)).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bits")) for m in masks))).alias("k")).select("fp", "id", "k.*")
    edges: list[DataFrame] = []
    while True:
        last = 64 - min(m.bit_count() for m in masks) <= last_bits
        sizes = rows.groupBy("mask", "bits").agg(F.count("*").alias("n")).where("n > 1")
        sized = saved(rows.join(sizes, ["mask", "bits"]), "buckets")
        small = sized if last else sized.where(F.col("n") <= bucket)
        members = small.groupBy("mask", "bits").agg(F.collect_list(F.struct("fp", "id")).alias("members")).select("members")
        edges.append(members.mapInArrow(forest, "a long, b long"))
        hot = sized.where(F.col("n") > bucket)
        if last or hot.isEmpty():
            return reduce(DataFrame.union, edges)
        finer = {m: [m | x for x in _split([i for i in range(64) if not m >> i & 1], d)] for m in masks}
        lookup = nodes.sparkSession.createDataFrame([(_signed(m), [_signed(x) for x in v]) for m, v in finer.items()], "mask long, finer array<long>")
        rows = hot.join(F.broadcast(lookup), "mask").select("fp", "id", F.explode("finer").alias("mask")).distinct().withColumn("bits", F.expr("fp & mask"))  # the table of masks has a fixed size
        masks = sorted({x for v in finer.values() for x in v})


def near_duplicates(docs: DataFrame, k: int = 5, max_distance: int = 3, bucket: int = 1024) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, fp, component_id), a row for each row of docs.

    component_id is the smallest doc_id reachable over links between fingerprints at max_distance or fewer differing
    bits; equal fingerprints link. Null and empty texts have fingerprint 0, linked like any other. Rows with a null
    doc_id take part in no link of their own and get the component of their fingerprint, or null. Repeated rows stay.
    """
    fps = saved(fingerprints(docs, k), "fingerprints")
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("id")).where("id is not null")
    nodes = saved(nodes, "nodes")
    parts = connected_components(link_edges(nodes, max_distance, bucket), "links")
    named = nodes.join(parts, nodes.id == parts.node, "left").select("fp", F.coalesce("component", "id").alias("component_id"))
    return fps.join(named, "fp", "left").select("doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame, k: int = 5, max_distance: int = 3, similarity: float | None = None) -> DataFrame:
    """One row of docs of each group: the one with the smallest doc_id (null last), of those the smallest hash of the text.

    Texts link if their fingerprints differ in at most max_distance bits or, with similarity, if their sets of k-word
    shingles have at least that Jaccard similarity, whatever their fingerprints. Each row is judged by its own text, so
    rows with a null or repeated doc_id count like others. Texts without a word are one group.
    """
    known, classes = (np.zeros(0, np.int64),) * 2 if similarity is None else shingles.common_shingles(docs, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches):
            fps = np.array([fingerprint(t, k) for t in texts], np.uint64).view(np.int64)
            sets = [] if similarity is None else list(shingles.shingle_sets(texts, k))
            keys = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets] or [0] * len(texts), np.uint64).view(np.int64)
            prefixes = [shingles.prefix(s, similarity, known, classes) for s in sets] or [None] * len(texts)
            yield record_batch(_ROWS, part.column("doc_id"), part.column("node"), fps, keys, np.array([len(s) for s in sets] or [0] * len(texts), np.int32), pa.array(prefixes, pa.list_(pa.int64())))

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), shingles.text_hash(docs).alias("node"), text.alias("text"))
    rows = saved(rows.mapInArrow(run, "doc_id long, node long, fp long, key long, n int, prefix array<long>"), "fingerprints")
    nodes = saved(rows.groupBy("fp").agg(F.min("node").alias("id")), "nodes")
    edges = [link_edges(nodes, max_distance), rows.join(nodes, "fp").select(F.col("node").alias("a"), F.col("id").alias("b"))]
    if similarity is not None:
        sets = saved(rows.groupBy("key").agg(F.min(F.struct("node", "n", "prefix")).alias("x")).select("key", "x.*"), "sets")
        edges.append(rows.select("key", F.col("node").alias("a")).join(sets.select("key", F.col("node").alias("b")), "key").select("a", "b"))
        edges.append(shingles.similar_edges(docs, sets.where("n > 0"), k, similarity))
    parts = connected_components(reduce(DataFrame.union, edges), "links")
    row = free_name(docs, "__row")
    named = rows.select("doc_id", "node", F.xxhash64("node", "doc_id").alias(row)).join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    first = named.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("x")).select(F.xxhash64("x.node", "x.doc_id").alias(row))
    counts = saved(named.groupBy(row).agg(F.count("*").alias("n")).join(first.withColumn("first", F.lit(True)), row, "left"), "rows")
    gone, twice = (saved(counts.where(which).select(row), "gone") for which in ("first is null", "first and n > 1"))
    # What goes is joined, not what stays, so texts stay in place unless more go than may be broadcast; of repeated rows one stays.
    kept = docs.withColumn(row, F.xxhash64(shingles.text_hash(docs), F.col("doc_id").cast("long"))).join(small(gone), row, "left_anti")
    if not twice.isEmpty():
        kept = kept.join(small(twice), row, "left_anti").union(kept.join(small(twice), row, "left_semi").dropDuplicates([row]))
    return kept.select(*columns(docs))
