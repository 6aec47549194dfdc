"""Vectorised hashes of words and word shingles."""

from __future__ import annotations

import numpy as np

#: ASCII white space: 9 to 13 and 32.
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_random = np.random.Generator(np.random.PCG64(20240229))
BYTE = np.where(SPACE, 0, _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
_STEP = 4096


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_BASE = 0x9E3779B97F4A7C15
LOW = _powers(_BASE, _STEP)
HIGH = _powers(pow(_BASE, _STEP, 2**64), _STEP)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """64-bit hash of every word (bytes between ASCII white space), in order."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    word = ~SPACE[data]
    starts = np.flatnonzero(word & ~np.concatenate([[False], word[:-1]]))
    if not len(starts):
        return np.zeros(0, np.uint64)
    data = data[starts[0] :]
    starts = starts - starts[0]
    lengths = np.diff(starts, append=len(data))
    inside = np.arange(len(data)) - np.repeat(starts, lengths)
    weight = LOW[inside % _STEP] if lengths.max() <= _STEP else LOW[inside % _STEP] * HIGH[inside // _STEP % _STEP]
    return mixed(np.add.reduceat(BYTE[data] * weight, starts))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; a shorter text is one shingle of all
    its words, a text without words has none."""
    words = word_hashes(text or "")
    n = len(words)
    if n == 0:
        return words
    width = min(size, n)
    total = np.zeros(n - width + 1, np.uint64)
    for j in range(width):
        # The rotation by the place keeps the order of the words in the sum.
        part = words[j : n - width + 1 + j] * np.uint64(2 * j + 0x51ED27)
        total += (part << np.uint64(j + 1)) | (part >> np.uint64(63 - j))
    return np.unique(mixed(total + np.uint64(width)))
