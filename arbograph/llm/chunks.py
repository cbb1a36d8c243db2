"""A table of distinct text chunks and their token ids: each chunk is segmented once, texts are put together by position."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa


def joined(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The slices flat[start : start + count], one after the other."""
    ends = np.cumsum(counts)
    return flat[np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)]


def flattened(lists: Sequence[Sequence[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.uint32, int(counts.sum())), counts


class ChunkTable(dict):
    """chunk -> code, and the ids of each code in one flat array.

    Looking up an unknown chunk gives it the next code; ``fill`` segments all new ones in one call. ``segment`` gives
    the ids of a list of chunks as one array, and their counts. A table that has passed ``limit`` chunks keeps, before
    the next texts, only chunks that came more than once (half the limit at most), so its memory is bounded.
    """

    def __init__(self, segment: Callable[[list], tuple[np.ndarray, np.ndarray]], limit: int = 400_000):
        self.segment, self.limit, self.new = segment, limit, []
        self.flat, self.counts, self.starts, self.seen = np.zeros(0, np.uint32), *(np.zeros(0, np.int64) for _ in range(3))

    def __missing__(self, chunk) -> int:
        self[chunk] = code = len(self)
        self.new.append(chunk)
        return code

    def shrink(self) -> None:
        if len(self) <= self.limit:
            return
        often = np.flatnonzero(self.seen > 1)
        often = np.sort(often[np.argsort(-self.seen[often], kind="stable")[: self.limit // 2]])
        chunks = list(self)
        self.clear()
        self.update(zip((chunks[i] for i in often.tolist()), range(len(often))))
        self.flat, self.counts = joined(self.flat, self.starts[often], self.counts[often]), self.counts[often]
        self.starts, self.seen = np.cumsum(self.counts) - self.counts, np.ones(len(often), np.int64)

    def fill(self, codes: np.ndarray) -> None:
        if self.new:
            (flat, counts), self.new = self.segment(self.new), []
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(counts) - counts])
            self.counts, self.flat = np.concatenate([self.counts, counts]), np.concatenate([self.flat, flat])
            self.seen = np.concatenate([self.seen, np.zeros(len(counts), np.int64)])
        self.seen += np.bincount(codes, minlength=len(self.seen))

    def codes(self, chunks: pa.StringArray) -> np.ndarray:
        """The code of each chunk, looked up once for each distinct one."""
        distinct = chunks.dictionary_encode()
        own = np.fromiter(map(self.__getitem__, distinct.dictionary.to_numpy(zero_copy_only=False).tolist()), np.int64, len(distinct.dictionary))
        return own[distinct.indices.to_numpy()]

    def put_together(self, codes: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each has, for texts of ``per_text`` codes each."""
        lens = self.counts[codes]
        upto = np.concatenate([[0], np.cumsum(lens)])[np.concatenate([[0], np.cumsum(per_text)])]
        return joined(self.flat, self.starts[codes], lens), np.diff(upto)

    def ids_of(self, chunked: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """``put_together`` for texts given as lists of chunks."""
        self.shrink()
        codes = self.codes(chunked.flatten())
        self.fill(codes)
        return self.put_together(codes, chunked.value_lengths().to_numpy())
