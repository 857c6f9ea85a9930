"""FM-index over a sequence of word ids: suffix array, Burrows-Wheeler
transform in a wavelet matrix with rank directories, sampled positions.

Symbol 0 separates runs; every separator counts as a symbol of its own, in
order of position, so suffixes never compare beyond the end of their run.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 32


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Prefix doubling until all ranks differ."""
    n = len(text)
    rank = np.where(text == 0, np.cumsum(text == 0) - 1, text.astype(np.int64) + n)
    step = 0
    while True:
        if step:
            ahead = np.zeros(n, dtype=np.int64)
            ahead[:-step] = rank[step:] + 1
            rank = rank * (n + 1) + ahead
        order = np.argsort(rank, kind="stable")
        ordered = rank[order]
        new = np.zeros(n, dtype=np.int64)
        new[1:] = np.cumsum(ordered[1:] != ordered[:-1])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = new
        step = step * 2 or 1
        if new[-1] == n - 1 or step >= n:
            return order


class Ranks:
    """A bit vector with ranks in constant time: counts before each 64-bit
    word plus a popcount within the word."""

    def __init__(self, bits: np.ndarray):
        self.words = np.zeros(len(bits) // 64 + 1, dtype="<u8")
        packed = np.packbits(bits, bitorder="little")
        self.words.view(np.uint8)[:len(packed)] = packed
        self.before = np.zeros(len(self.words), dtype=np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Set bits in [0, i)."""
        w, b = i >> 6, (i & 63).astype(np.uint64)
        return self.before[w] + np.bitwise_count(self.words[w] & ((np.uint64(1) << b) - np.uint64(1)))

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, width: int):
        self.width, self.levels, self.zeros = width, [], []
        s = symbols
        for level in range(width - 1, -1, -1):
            bits = (s >> level) & 1
            self.levels.append(Ranks(bits.astype(np.uint8)))
            self.zeros.append(int(len(s) - bits.sum()))
            s = np.concatenate([s[bits == 0], s[bits == 1]])

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of c[k] in the first i[k] symbols."""
        start = np.zeros_like(i)
        for level, (r, z) in enumerate(zip(self.levels, self.zeros)):
            one = ((c >> (self.width - 1 - level)) & 1).astype(bool)
            a, b = r.ones(start), r.ones(i)
            start = np.where(one, z + a, start - a)
            i = np.where(one, z + b, i - b)
        return i - start

    def access(self, i: np.ndarray) -> np.ndarray:
        c = np.zeros(len(i), dtype=np.int64)
        for r, z in zip(self.levels, self.zeros):
            bit = r.get(i).astype(np.int64)
            ones = r.ones(i)
            i = np.where(bit == 1, z + ones, i - ones)
            c = c << 1 | bit
        return c


class FMIndex:
    def __init__(self, text: np.ndarray, alphabet: int):
        """``text`` holds ids below ``alphabet``; it starts with 0."""
        sa = suffix_array(text)
        bwt = text[sa - 1].astype(np.int64)
        self.n = len(text)
        self.tree = WaveletMatrix(bwt, max(1, int(alphabet - 1).bit_length()))
        self.first = np.zeros(alphabet + 1, dtype=np.int64)
        np.cumsum(np.bincount(text, minlength=alphabet), out=self.first[1:])
        # positions are kept at every SAMPLE-th place and at run starts, so a
        # walk never has to cross a separator
        marked = (sa % SAMPLE == 0) | (bwt == 0)
        self.marked, self.kept = Ranks(marked.astype(np.uint8)), sa[marked]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row intervals [lo, hi) of each pattern (rows padded on the left
        with 0, so that all end in the last column)."""
        lo = np.zeros(len(patterns), dtype=np.int64)
        hi = np.where(lengths > 0, self.n, 0)
        width = patterns.shape[1]
        for back in range(1, width + 1):
            live = np.flatnonzero((lengths >= back) & (lo < hi))
            if not len(live):
                break
            c = patterns[live, width - back]
            both = self.tree.rank(np.concatenate([c, c]), np.concatenate([lo[live], hi[live]]))
            lo[live] = self.first[c] + both[:len(live)]
            hi[live] = self.first[c] + both[len(live):]
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows of the suffix array."""
        at, steps = rows.copy(), np.zeros(len(rows), dtype=np.int64)
        todo = np.arange(len(rows))
        while True:
            todo = todo[self.marked.get(at[todo]) == 0]
            if not len(todo):
                return self.kept[self.marked.ones(at)] + steps
            c = self.tree.access(at[todo])
            at[todo] = self.first[c] + self.tree.rank(c, at[todo])
            steps[todo] += 1
