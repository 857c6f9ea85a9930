"""Elias-Fano code of a non-decreasing sequence of integers.

n values up to u take about n * (2 + log2(u / n)) bits: the low
floor(log2(u / n)) bits of each value are stored plainly, the rest as gaps in
unary in one bit vector.  A select structure (the position of every 64th one)
finds value i without reading the vector from its start.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 64
# by byte: its number of ones, and the place of its k-th one
ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(axis=1).astype(np.int64)
PLACE = np.argsort(1 - np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little"),
                   axis=1, kind="stable")
HEAD = struct.Struct("<QQBxxxxxxxQQQ")     # n, u, low bits, bytes of low / high / samples


class EliasFano:
    def __init__(self, n: int, u: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.u, self.low_bits = n, u, low_bits
        self._raw = (low, high, samples)
        # padded so that a value's low bits can be read as one word and a byte
        self._low = np.frombuffer(low + bytes(9), np.uint8)
        self._high = np.frombuffer(high, np.uint8)
        self._samples = np.frombuffer(samples, "<u8")

    @classmethod
    def encode(cls, values) -> EliasFano:
        v = np.asarray(values, dtype=np.uint64)
        n = len(v)
        if n and np.any(v[1:] < v[:-1]):
            raise ValueError("values must not decrease")
        u = int(v[-1]) if n else 0
        low_bits = max(0, (u // max(n, 1)).bit_length() - 1)
        low = b""
        if low_bits and n:
            bits = (v[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
            low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
        ones = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n, dtype=np.int64)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
        high[ones] = 1
        return cls(n, u, low_bits, low, np.packbits(high, bitorder="little").tobytes(),
                   ones[::SAMPLE].astype("<u8").tobytes())

    def to_bytes(self) -> bytes:
        return HEAD.pack(self.n, self.u, self.low_bits, *map(len, self._raw)) + b"".join(self._raw)

    @classmethod
    def from_bytes(cls, data: bytes, at: int = 0) -> tuple[EliasFano, int]:
        """The structure at offset ``at`` and the offset behind it."""
        if len(data) < at + HEAD.size:
            raise ValueError("truncated Elias-Fano header")
        n, u, low_bits, a, b, c = HEAD.unpack_from(data, at)
        at += HEAD.size
        if len(data) < at + a + b + c:
            raise ValueError("truncated Elias-Fano body")
        low, high, samples = data[at:at + a], data[at + a:at + a + b], data[at + a + b:at + a + b + c]
        return cls(n, u, low_bits, low, high, samples), at + a + b + c

    def select(self, i: int) -> int:
        """Value i, from the nearest sample onwards."""
        return int(self.select_many(np.array([i]))[0])

    def select_many(self, index: np.ndarray) -> np.ndarray:
        """The values at ``index``: each starts at its nearest sample and
        skips whole bytes by their number of ones; all go side by side."""
        i = np.asarray(index, dtype=np.int64)
        if len(i) and not (0 <= i.min() and i.max() < self.n):
            raise IndexError("no such value")
        start = self._samples[i // SAMPLE].astype(np.int64)
        byte, left = start // 8, i % SAMPLE
        bits = self._high[byte] & (0xFF << (start % 8)).astype(np.uint8)
        todo = np.flatnonzero(left >= ONES[bits])
        while len(todo):
            left[todo] -= ONES[bits[todo]]
            byte[todo] += 1
            bits[todo] = self._high[byte[todo]]
            todo = todo[left[todo] >= ONES[bits[todo]]]
        one = byte * 8 + PLACE[bits, left]
        return ((one - i) << self.low_bits) | self._lows(i)

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), dtype=np.int64)
        at = i * self.low_bits
        word = self._low[(at // 8)[:, None] + np.arange(8)].astype(np.uint64)
        v = (word << (np.arange(8, dtype=np.uint64) * np.uint64(8))).sum(axis=1, dtype=np.uint64)
        shift = (at % 8).astype(np.uint64)
        v >>= shift
        over = shift > 0
        v[over] |= self._low[at[over] // 8 + 8].astype(np.uint64) << (np.uint64(64) - shift[over])
        return (v & np.uint64((1 << self.low_bits) - 1)).astype(np.int64)

    def all(self) -> np.ndarray:
        """Every value, in one pass."""
        ones = np.flatnonzero(np.unpackbits(self._high, bitorder="little"))[:self.n]
        n = np.arange(self.n, dtype=np.int64)
        return ((ones - n) << self.low_bits) | self._lows(n)
