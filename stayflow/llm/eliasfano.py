"""Elias-Fano coded monotone numbers: low bits packed, high bits as gaps in a bit vector."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: The place of every so many-th one is stored, so that select looks at a bounded stretch.
SAMPLE = 256
_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(axis=1)


@dataclass(frozen=True)
class EliasFano:
    """n numbers in order, under 2**32, in about 2 + log2(last / n) bits each."""

    n: int
    low_bits: int
    low: bytes
    high: bytes
    samples: bytes

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        if not n:
            return cls(0, 0, b"", b"", b"")
        low_bits = max(0, int(values[-1] // n).bit_length() - 1)
        bits = (values[:, None] >> np.arange(low_bits)) & 1
        ones = (values >> low_bits) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1, np.uint8)
        high[ones] = 1
        return cls(
            n, low_bits,
            np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes(),
            np.packbits(high, bitorder="little").tobytes(),
            ones[::SAMPLE].astype("<u4").tobytes(),
        )

    def all(self) -> np.ndarray:
        if not self.n:
            return np.zeros(0, np.int64)
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))
        bits = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little", count=self.n * self.low_bits)
        low = bits.reshape(self.n, self.low_bits).astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))
        return ((ones - np.arange(self.n)) << self.low_bits) | low

    def select(self, i: int) -> int:
        """The i-th number, from the nearest sample and the bytes after it."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at = int(np.frombuffer(self.samples, "<u4")[i // SAMPLE])
        left, byte = i % SAMPLE, at // 8
        data = np.frombuffer(self.high, np.uint8)
        first = data[byte] & (0xFF << at % 8 & 0xFF)
        while True:
            here = int(_ONES[first])
            if left < here:
                place = np.flatnonzero(np.unpackbits(np.array([first], np.uint8), bitorder="little"))[left]
                break
            left, byte = left - here, byte + 1
            first = data[byte]
        low = 0
        for j in range(self.low_bits):
            bit = i * self.low_bits + j
            low |= (self.low[bit // 8] >> bit % 8 & 1) << j
        return (byte * 8 + int(place) - i) << self.low_bits | low
