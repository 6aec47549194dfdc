"""A compressed full-text index of number sequences: wavelet tree over the Burrows-Wheeler transform.

Only the wavelet tree (packed bits with counts), the symbol starts and the marks of the intervals of
one match length are kept; the suffix array lives while they are made.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """Packed bits; ``rank`` counts the ones before places."""

    def __init__(self, bits: np.ndarray):
        packed = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
        some = np.packbits(bits, bitorder="little")
        packed[: len(some)] = some
        self.words = packed.view(np.uint64)
        self.before = np.zeros(len(self.words), np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])
        self.ones = int(np.count_nonzero(bits))

    def rank(self, places: np.ndarray) -> np.ndarray:
        word = places >> 6
        below = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class WaveletTree:
    """A sequence of symbols, one row of bits per binary digit, highest first; each next row has the
    symbols with a zero first."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.digits = max(1, int(n_symbols - 1).bit_length())
        self.rows: list[tuple[Bits, int]] = []
        for digit in reversed(range(self.digits)):
            one = (symbols >> digit & 1).astype(bool)
            self.rows.append((Bits(one), len(symbols) - int(np.count_nonzero(one))))
            symbols = np.concatenate([symbols[~one], symbols[one]])
        every = np.arange(n_symbols)
        #: Where the places of each symbol begin in the order below the last row.
        self.first = self.sunk(every, np.zeros(n_symbols, np.int64))

    def sunk(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Places carried through the rows, each as its symbol's digits say."""
        for digit, (bits, zeros) in zip(reversed(range(self.digits)), self.rows):
            ones = bits.rank(places)
            places = np.where(symbols >> digit & 1, zeros + ones, places - ones)
        return places

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        return self.sunk(symbols, places) - self.first[symbols]


def suffix_order(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Suffixes in the order of their first ``depth`` symbols; and numbers that order their first
    ``reach`` symbols, the power of two below ``depth``, for comparisons of shorter lengths."""
    n = len(symbols)
    number, reach = symbols.astype(np.int64), 1

    def keys(step: int) -> np.ndarray:
        ahead = np.zeros(n, np.int64)
        ahead[: max(0, n - step)] = number[step:]
        return number * (n + 1) + ahead

    while True:
        last = reach * 2 >= depth
        key = keys(depth - reach if last else reach)
        order = np.argsort(key)
        if last:
            return order, number, reach
        held = key[order]
        fresh = np.empty(n, np.int64)
        fresh[order] = np.concatenate([[1], 1 + np.cumsum(held[1:] != held[:-1])])
        number, reach = fresh, reach * 2


class FMIndex:
    """Index of a text of symbols from 1 on, with 0 between its passages, for matches of ``length``.

    ``first`` has for each interval of equal passages of that length the least text place.
    """

    def __init__(self, text: np.ndarray, length: int):
        n, self.length = len(text), length
        n_symbols = int(text.max()) + 1
        # Symbols are dense, so they can serve as the first numbers of the suffix order.
        order, number, reach = suffix_order(text, length + 1)
        self.tree = WaveletTree(text[order - 1], n_symbols)
        counts = np.bincount(text, minlength=n_symbols)
        self.start = np.concatenate([[0], np.cumsum(counts)[:-1]])
        ahead = np.zeros(n, np.int64)
        step = length - reach
        ahead[: n - step] = number[step:]
        a, b = number[order], ahead[order]
        new = np.ones(n, bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        self.marks = Bits(new)
        self.edges = np.append(np.flatnonzero(new), n)
        self.first = np.minimum.reduceat(order, self.edges[:-1])

    def back(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """A bound of an interval after a step to the symbols before its matches."""
        return self.start[symbols] + self.tree.rank(symbols, places)

    def interval(self, low: np.ndarray) -> np.ndarray:
        """The number of the interval of length ``length`` that holds a row."""
        return self.marks.rank(low + 1) - 1

    def matching_statistics(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """For each passage [start, end) of a streamed text, from its end to its start by backward
        search: yields (places, low, high), the interval of the ``length`` symbols from each place.

        A match that is one symbol longer than ``length`` is widened to the interval of its first
        ``length`` symbols. All passages step side by side; the symbols must occur in the index.
        """
        by_length = np.argsort(starts - ends, kind="stable")
        starts, ends = starts[by_length], ends[by_length]
        sizes = ends - starts
        low = np.zeros(len(starts), np.int64)
        high = np.full(len(starts), self.edges[-1], np.int64)
        for step in range(int(sizes[0]) if len(sizes) else 0):
            live = int(np.searchsorted(-sizes, -step, side="left"))
            place = ends[:live] - 1 - step
            symbol = text[place]
            both = self.back(np.concatenate([symbol, symbol]), np.concatenate([low[:live], high[:live]]))
            low, high = both[:live], both[live:]
            found = high > low
            if not found.all():
                raise ValueError("a streamed passage is not in the index")
            if step + 1 < self.length:
                continue
            if step + 1 > self.length:
                group = self.interval(low)
                low, high = self.edges[group], self.edges[group + 1]
            yield place, low, high
