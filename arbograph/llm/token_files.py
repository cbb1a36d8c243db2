"""Token ids of a corpus as files of Simple-8b blocks.

A corpus is a table of blocks in ascending order of doc_id: shard (a contiguous range of doc_ids), block (its number in
the shard), first_id (ids of the shard before it), doc_ids, lengths (ids of each document, Simple-8b words), n_ids,
words (Simple-8b words of the ids, little-endian), exception_at and exceptions (ids that 60 bits can't hold, patched in
after decoding). Blocks hold whole documents, so a reader decodes any block by itself and all its words at once. The
container is Parquet, written by Spark's committer: it works on any store and a lost executor's task is just run again.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .batches import record_batch, slices
from .chunks import ChunkTable, flattened, joined

#: Fixed values of the coding: selector i packs COUNTS[i] ids of WIDTHS[i] bits in the low 60 bits of a word.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
END_ID = 1
BLOCK_IDS = 1 << 16
_FILE = pa.schema(
    [("shard", pa.int32()), ("block", pa.int32()), ("first_id", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_ids", pa.int64()), ("lengths", pa.binary()), ("words", pa.binary()), ("exception_at", pa.list_(pa.int64())), ("exceptions", pa.list_(pa.decimal128(20, 0)))]
)
_FILE_DDL = "shard int, block int, first_id long, doc_ids array<long>, n_ids long, lengths binary, words binary, exception_at array<long>, exceptions array<decimal(20,0)>"
_DOCS = pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """uint64 values -> (Simple-8b words, positions of the exceptions). The last word is filled up with zeros."""
    values = np.asarray(values, np.uint64)
    exceptions = np.flatnonzero(values >> np.uint64(60))
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64), exceptions
    padded = np.zeros(n + COUNTS[0], np.uint64)
    padded[:n] = values
    padded[exceptions] = 0
    limits = np.array([(1 << int(w)) - 1 for w in WIDTHS[1:]], np.uint64)
    need = np.searchsorted(limits, padded).astype(np.uint8)  # 0 for a zero, else the place of the narrowest width
    windows, most, width = {1: need}, need, 1
    while width * 2 <= COUNTS[0]:
        most = np.maximum(most[:-width], most[width:])
        width *= 2
        windows[width] = most
    best = np.full(n, len(COUNTS) - 1, np.uint8)
    for s in range(len(COUNTS) - 2, -1, -1):
        c = int(COUNTS[s])
        p = 1 << (c.bit_length() - 1)
        fits = np.maximum(windows[p][:n], windows[p][c - p : c - p + n]) <= max(s - 1, 0)
        best[fits] = s
    chosen, count, at, starts = best.tobytes(), COUNTS.tolist(), 0, []
    while at < n:
        starts.append(at)
        at += count[chosen[at]]
    starts = np.array(starts)
    chosen = best[starts]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s in np.unique(chosen):
        if WIDTHS[s]:
            mine = np.flatnonzero(chosen == s)
            for i in range(COUNTS[s]):
                words[mine] |= padded[starts[mine] + i] << np.uint64(i * WIDTHS[s])
    return words, exceptions


def unpack(words: np.ndarray, n: int) -> np.ndarray:
    """The n values of the words, selector by selector, each in one vector operation."""
    chosen = (words >> np.uint64(60)).astype(np.int64)
    ends = np.cumsum(COUNTS[chosen])
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    for s in np.unique(chosen):
        if WIDTHS[s]:
            mine = np.flatnonzero(chosen == s)
            shifts = (np.arange(COUNTS[s]) * WIDTHS[s]).astype(np.uint64)
            out[(ends[mine] - COUNTS[s])[:, None] + np.arange(COUNTS[s])] = (words[mine, None] >> shifts) & np.uint64((1 << int(WIDTHS[s])) - 1)
    return out[:n]


#: Marks that always end a run of letters and start a pre-token of their own.
_MARKS = ".,!?*%&$#;:"
_LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch


class WordEncoder(ChunkTable):
    """Encodes the words between ASCII white space, which no pre-token of the tokenizer crosses.

    A word is the stem and up to eight marks at its end; both are chunks of the table. Stems that are one run of letters
    go to the library many at a time, as one text: each ends with the one token that carries the end-of-word suffix.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__(self._distinct, limit=250_000)
        self.tokenizer = Tokenizer.from_file(path)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        if suffix:
            self.last[[i for t, i in vocab.items() if t.endswith(suffix)]] = True

    def _whole(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _distinct(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        runs = np.fromiter((_LETTERS(t) is not None for t in texts), bool, len(texts))
        letters = [t for t, r in zip(texts, runs) if r]
        flat, counts = flattened(self._whole([" ".join(letters[i : i + 200]) for i in range(0, len(letters), 200)]))
        ends = np.flatnonzero(self.last[flat]) + 1
        if len(ends) != len(letters):
            return flattened(self._whole(texts))
        rest, rest_counts = flattened(self._whole([t for t, r in zip(texts, runs) if not r]))
        order = np.argsort(np.concatenate([np.flatnonzero(runs), np.flatnonzero(~runs)]))
        counts = np.concatenate([np.diff(ends, prepend=0), rest_counts])
        starts = np.concatenate([ends, len(flat) + np.cumsum(rest_counts)]) - counts
        return joined(np.concatenate([flat, rest]), starts[order], counts[order]), counts[order]

    @staticmethod
    def _stems(words: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
        """The stem of each word, and its marks as the bytes of a number."""
        stems = pc.ascii_rtrim(words, characters=_MARKS)
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
        starts = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words)]
        whole, short = (pc.binary_length(x).to_numpy() for x in (words, stems))
        size = whole - short
        cut = np.flatnonzero((size > 0) & (size <= 8) & (short > 0) & ~pc.match_substring(words, "<").to_numpy(zero_copy_only=False))
        cut = cut[np.isin(data[starts[cut] + short[cut] - 1] | 32, np.arange(0x61, 0x7B, dtype=np.uint8))]
        is_cut, marks = np.zeros(len(words), bool), np.zeros(len(words), np.uint64)
        is_cut[cut] = True
        for j in range(8):
            more = cut[size[cut] > j]
            marks[more] = (marks[more] << np.uint64(8)) | data[starts[more] + short[more] + j]
        return pc.if_else(pa.array(is_cut), stems, words), marks

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each has; null counts as empty."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words = lists.flatten().dictionary_encode()
        stems, marks = self._stems(words.dictionary)
        kinds, kind = np.unique(marks, return_inverse=True)
        self.shrink()
        codes = np.stack([self.codes(stems), np.array([self[int(k).to_bytes(8, "big").lstrip(b"\0").decode()] for k in kinds], np.int64)[kind]], axis=1)
        self.fill(codes.ravel())
        return self.put_together(codes[words.indices.to_numpy()].ravel(), 2 * lists.value_lengths().to_numpy())


@cache  # a worker that is used again keeps its table
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def write_tokens(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = END_ID, shards: int | None = None) -> None:
    """Write the ids of every whole text of docs(doc_id, text), each with end_id appended, in ascending doc_id order.

    A null text counts as empty; rows with a null doc_id come first; rows that share a doc_id stay, ordered by text.
    The tokenizer must keep white space out of its pre-tokens, as word-level BPE with dropped white space does.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, encoder, block, first = TaskContext.get().partitionId(), word_encoder(tokenizer_path), 0, 0
        for part in slices(batches, limit=4 << 20):
            ids, lengths = encoder.encode(part.column("text"))
            ids, lengths = np.insert(ids, np.cumsum(lengths), end_id).astype(np.uint64), lengths + 1
            doc_ids, ends, at = part.column("doc_id").to_pylist(), np.cumsum(lengths), 0
            while at < len(doc_ids):
                begin = int(ends[at] - lengths[at])
                to = max(at + 1, int(np.searchsorted(ends, begin + BLOCK_IDS, side="right")))
                own = ids[begin : ends[to - 1]]
                words, odd = pack(own)
                yield record_batch(_FILE, [shard], [block], [first], [doc_ids[at:to]], [len(own)], [pack(lengths[at:to])[0].astype("<u8").tobytes()], [words.astype("<u8").tobytes()], [odd.tolist()], [[int(x) for x in own[odd]]])
                block, first, at = block + 1, first + len(own), to

    spread = [F.col("doc_id"), F.xxhash64("text").alias("h")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.repartitionByRange(shards, *spread) if shards else rows.repartitionByRange(*spread)
    rows.sortWithinPartitions("doc_id", F.xxhash64("text")).mapInArrow(run, _FILE_DDL).write.parquet(path)


def decoded(block: dict) -> tuple[np.ndarray, np.ndarray]:
    """(ids, lengths) of one block of the file, a row as a dict."""
    ids = unpack(np.frombuffer(block["words"], "<u8"), block["n_ids"])
    if block["exception_at"]:
        ids[block["exception_at"]] = [int(x) for x in block["exceptions"]]
    return ids, unpack(np.frombuffer(block["lengths"], "<u8"), len(block["doc_ids"])).astype(np.int64)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document of the files; start counts the ids of all documents before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                ids, lengths = decoded(row)
                ends = np.cumsum(lengths)
                raw = memoryview(ids.astype("<u4").tobytes())
                yield record_batch(_DOCS, np.full(len(ends), row["shard"], np.int32), row["doc_ids"], row["first_id"] + ends - lengths, lengths, [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())])

    blocks = spark.read.schema(_FILE_DDL).parquet(path)
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))  # a row for each file
    before = totals.select("shard", (F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")).alias("before"))
    docs = blocks.mapInArrow(run, "shard int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return docs.join(before, "shard").select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
