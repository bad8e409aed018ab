"""Vectorised word hashing, and arithmetic folds, shared by the learned operators and joins.

A word is a run of digits, a-z (A-Z lowered) and bytes from 0x80 up, so of any letters beyond
ASCII.  Hashes are 64-bit and the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Lowers A-Z and turns every byte outside words into 0.
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 0 for c in range(256))
# Odd multipliers: the 64-bit golden ratio and the steps of the splitmix64 finaliser.
_BASE = 0x9E3779B97F4A7C15
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
# Bytes hashed at once; longer texts are cut between words.
_BLOCK = 1 << 18


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown as needed."""

    def __init__(self, base: int):
        self._base, self._table = base, np.ones(1, dtype=np.uint64)

    def __call__(self, n: int) -> np.ndarray:
        if len(self._table) < n:
            grown = np.full(max(n, 2 * len(self._table)), self._base, dtype=np.uint64)
            grown[0] = 1
            self._table = np.multiply.accumulate(grown)
        return self._table[:n]


_up, _down = _Powers(_BASE), _Powers(pow(_BASE, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def _blocks(raw: bytes) -> Iterator[bytes]:
    """The text in blocks that end between words, each with a blank at both ends."""
    start = 0
    while start < len(raw):
        stop = start + _BLOCK
        if stop < len(raw):
            cut = raw.rfind(b"\0", start, stop)
            if cut < 0:
                cut = raw.find(b"\0", stop)
            stop = cut + 1 if cut >= 0 else len(raw)
        yield b"\0" + raw[start:stop] + b"\0"
        start = stop


def word_hashes(text: str | None, *starts: int) -> list[np.ndarray]:
    """The hash of every word in order; then, for each number in ``starts``, of so many first bytes of it."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES)
    found: list[list[np.ndarray]] = [[] for _ in range(1 + len(starts))]
    for block in _blocks(raw):
        data = np.frombuffer(block, dtype=np.uint8)
        inside = data != 0
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        if not len(edges):
            continue
        # Sums of byte x power up to each byte; a word's hash is a difference, moved back to power 0.
        sums = np.cumsum(data * _up(len(data)))
        first, last = edges[::2], edges[1::2]
        before, back = sums[first], _down(len(data))[first]
        found[0].append(mix((sums[last] - before) * back))
        for k, out in zip(starts, found[1:], strict=True):
            out.append(mix((sums[np.minimum(first + k, last)] - before) * back))
    return [np.concatenate(x) if x else np.empty(0, dtype=np.uint64) for x in found]


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of k consecutive words; fewer words are one shingle, none is none."""
    if not len(words):
        return words
    k = min(k, len(words))
    n = len(words) - k + 1
    out = np.full(n, k, dtype=np.uint64)
    for i in range(k):
        out = out * np.uint64(_BASE) + words[i : i + n]
    return np.unique(mix(out))


def remainder(doc_id: str, k: int) -> Column:
    """crc32 of the id as text modulo k; null ids have none."""
    return F.crc32(F.col(doc_id).cast("string")) % k


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))
