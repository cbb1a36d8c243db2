"""Pairs of texts whose sets of k-word shingles reach a Jaccard similarity, by a prefix join that loses no pair.

A set is the 64-bit hashes of a text's shingles. Two sets at the threshold share a hash of their prefixes in any common
order; shingles that many texts have come last, so that a passage many texts quote makes no candidates. A pair is a
candidate if its prefixes share as many hashes as the threshold asks for. Members of a crowded prefix hash are first
compared with one leader of about their size, and pairs that this has already connected are not compared again: what
counts is the component. Candidates are verified on the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .batches import discard, record_batch, release, saved, small, text_chunks
from .bytewords import gram_hashes, words_of
from .components import connected_components

#: Shingles that a worker counts at a time, and the most common ones that are put last (which changes no result).
COUNTED, COMMON = 1 << 20, 1 << 16
#: Members of a prefix hash from which they are first compared with a leader. An estimate, not measured.
HOT = 32
_WORD = np.array([not (b == 0x20 or 0x09 <= b <= 0x0D) for b in range(256)])
_COUNTS = pa.schema([("s", pa.int64()), ("n", pa.int64())])
_SETS = pa.schema([("node", pa.int64()), ("set", pa.list_(pa.int64()))])


def shingle_sets(texts: list[str], k: int) -> Iterator[np.ndarray]:
    """Of each text its distinct shingle hashes, ascending; fewer words than k make one shingle, none an empty set."""
    w = words_of(texts, _WORD)
    grams = gram_hashes(w.hashes, k)
    for at, to in zip(w.first.tolist(), w.first[1:].tolist()):
        n = to - at
        yield np.unique(grams[at : to - k + 1] if n >= k else gram_hashes(w.hashes[at:to], n) if n else grams[:0]).view(np.int64)


def common_shingles(docs: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, class) of shingles that repeat in what one worker counts at a time, hashes ascending."""

    def repeated(sets: list[np.ndarray]) -> pa.RecordBatch:
        s, n = np.unique(np.concatenate(sets), return_counts=True)
        return record_batch(_COUNTS, s[n > 2], n[n > 2])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, texts in text_chunks(batches):
            for one in shingle_sets(texts, k):
                held.append(one)
                size += len(one)
            if size >= COUNTED:
                yield repeated(held)
                held, size = [], 0
        if held:
            yield repeated(held)

    found = docs.select("text").mapInArrow(run, "s long, n long").groupBy("s").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "s").limit(COMMON).toArrow().sort_by("s")
    return found["s"].to_numpy(), 1 + np.log2(found["n"].to_numpy()).astype(np.int64)


def prefix(one: np.ndarray, threshold: float, known: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The hashes of a set that any set at the threshold must share one of with its own prefix."""
    n = len(one)
    if not n:
        return one
    kind = np.zeros(n, np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, one), len(known) - 1)
        kind = np.where(known[at] == one, classes[at], 0)
    return one[np.lexsort((one, kind))][: n - int(np.ceil(n * threshold - 1e-9)) + 1]


def similar_edges(docs: DataFrame, nodes: DataFrame, k: int, threshold: float, hot: int = HOT) -> DataFrame:
    """docs(text), nodes(node, n, prefix; node is xxhash64 of a text of docs, sets distinct) -> (a, b): verified pairs, whose
    components are those of all pairs of nodes at the threshold."""
    words = nodes.select("node", "n", F.posexplode("prefix").alias("i", "s"))
    shared = small(saved(words.groupBy("s").agg(F.count("*").alias("m")).where("m > 1"), "shared"))
    post = saved(words.join(shared, "s"), "postings")

    m, n = F.col("a.n"), F.col("b.n")
    alike = (F.col("a.s") == F.col("b.s")) & (F.least(m, n) >= F.greatest(m, n) * threshold - 1e-9)
    # Of two prefixes, the one that ends first in the common order has all its shared hashes in the other, so a pair shares
    # no more than those and the rest of that set.
    rest = F.ceil(F.col("most") * threshold - 1e-9) - 1
    enough = F.col("shared") >= (F.col("least") + F.col("most")) * (threshold / (1 + threshold)) - 1e-9 - rest

    def counted(pairs: DataFrame) -> DataFrame:
        """(a, b, shared) of pairs, a row for each hash, that share enough of their prefixes."""
        return pairs.groupBy("a", "b", "least", "most").agg(F.count("*").alias("shared")).where(enough).select("a", "b", "shared")

    sizes = [F.least(m, n).alias("least"), F.greatest(m, n).alias("most")]

    def verified(pairs: DataFrame) -> DataFrame:
        needed = small(saved(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "needed"))
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, texts in text_chunks(batches):
                yield record_batch(_SETS, part.column("node"), pa.array(list(shingle_sets(texts, k)), pa.list_(pa.int64())))

        rows = docs.select(text_hash(docs).alias("node"), "text").join(needed, "node", "left_semi").mapInArrow(run, "node long, set array<long>")
        sets = saved(rows.dropDuplicates(["node"]), "sets")
        both = pairs.join(sets.select(F.col("node").alias("a"), "set"), "a").join(sets.select(F.col("node").alias("b"), F.col("set").alias("set2")), "b")
        both = both.select("a", "b", F.size("set").alias("m"), F.size("set2").alias("n"), F.size(F.array_intersect("set", "set2")).alias("both"))
        out = saved(both.where(F.col("both") >= (F.col("m") + F.col("n") - F.col("both")) * threshold - 1e-9).select("a", "b"), "similar")
        discard(sets)
        return out

    crowd = post.where(F.col("m") > hot)
    led, parts = None, post.select("node", F.col("node").alias("c")).limit(0)
    if not crowd.isEmpty():
        size = F.log("n") / float(np.log(1.25))  # two sizes that can match share one of two bands that overlap
        banded = crowd.select("s", "node", "n", "i", F.explode(F.array(F.floor(size) * 2, F.floor(size + 0.5) * 2 + 1)).alias("band"))
        lead = banded.groupBy("s", "band").agg(F.min(F.struct("node", "n", "i")).alias("l")).select("s", "band", "l.*")
        pairs = banded.alias("a").join(lead.alias("b"), alike & (F.col("a.band") == F.col("b.band")) & (F.col("a.node") != F.col("b.node"))).select(F.col("a.node").alias("a"), F.col("b.node").alias("b"), *sizes)
        best = counted(pairs).groupBy("a").agg(F.max(F.struct("shared", "b")).alias("x"))
        led = verified(saved(best.select("a", F.col("x.b").alias("b")), "led"))
        parts = connected_components(led, "led").select("node", F.col("component").alias("c"))
    # Of the members of a hash, those outside its largest component are compared with all others that they aren't connected with.
    named = post.join(parts, "node", "left").select("s", "node", "n", "i", F.coalesce("c", "node").alias("c"))
    named = saved(named, "named")
    main = named.groupBy("s", "c").agg(F.count("*").alias("m")).groupBy("s").agg(F.max(F.struct("m", "c")).alias("x"), F.count("*").alias("parts")).where("parts > 1").select("s", F.col("x.c").alias("main"))
    mixed = saved(named.join(main, "s"), "mixed")
    a, b = mixed.where("c <> main").alias("a"), mixed.alias("b")
    once = (F.col("b.c") == F.col("b.main")) | (F.col("a.node") < F.col("b.node"))
    pairs = a.join(b, alike & (F.col("a.c") != F.col("b.c")) & once).select(F.greatest("a.node", "b.node").alias("a"), F.least("a.node", "b.node").alias("b"), *sizes)
    pairs = saved(counted(pairs).select("a", "b"), "pairs")
    found = verified(pairs)
    for used in (post, named, mixed, pairs):
        discard(used)
    release(docs.sparkSession)
    return found if led is None else found.union(led)


def text_hash(docs: DataFrame):
    """A 64-bit hash of a row's text; null is empty."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
