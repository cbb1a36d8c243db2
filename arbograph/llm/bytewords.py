"""Vectorised words of many texts at once: where they lie in the bytes, whose they are, and a 64-bit hash of each."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads every bit over the word."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Powers:
    """BASE and its inverse to the powers 0, 1, 2 ... modulo 2**64, as far as the longest text so far."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 1 << 16)
            cls.up, cls.down = (np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, x, np.uint64))]) for x in (_BASE, _INVERSE))
        return cls.up[:n], cls.down[:n]


@dataclass
class Words:
    data: bytes
    starts: np.ndarray  # of each word
    ends: np.ndarray
    text: np.ndarray  # the text that each word is in
    first: np.ndarray  # of each text, its first word; one more at the end
    hashes: np.ndarray
    begins: np.ndarray  # of each text in the bytes; one more at the end

    def span(self, at: int, n: int) -> str:
        """n words from a word on, space-joined."""
        return b" ".join(self.data[s:e] for s, e in zip(self.starts[at : at + n].tolist(), self.ends[at : at + n].tolist())).decode("utf-8", "replace")


def words_of(texts: list[str], is_word: np.ndarray, lower: bool = True, hashed: bool = True) -> Words:
    """Words are the longest runs of bytes for which the table is_word holds; line ends must not be among them."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = b"\n".join(raw) + b"\n"
    data = data.lower() if lower else data
    codes = np.frombuffer(data, np.uint8)
    inside = is_word[codes]
    edges = np.flatnonzero(np.diff(inside, prepend=False))  # the last byte is a line end
    starts, ends = edges[::2], edges[1::2]
    begins = np.cumsum([0] + [len(r) + 1 for r in raw])
    first = np.searchsorted(starts, begins)
    text = np.repeat(np.arange(len(texts)), np.diff(first))
    hashes = np.zeros(0, np.uint64)
    if hashed:
        up, down = _Powers.to(len(codes) + 1)
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
        hashes = mixed((sums[ends] - sums[starts]) * down[starts])
    return Words(data, starts, ends, text, first, hashes, begins)


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k words in a row; texts are not told apart here."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out = out * np.uint64(_BASE) + hashes[j : j + n]
    return mixed(out)
