"""Longest common extensions by recompression.

A sequence of integers is compressed in rounds.  Block compression replaces
each maximal block of one symbol by a symbol for (symbol, length); pair
compression splits the symbols into a left and a right half by a hash and
replaces each left-right pair by a symbol.  Equal stretches are cut alike, up
to their ends, in every round, so the levels are a run-length grammar: the
extension from two places climbs while both stand at the start of a symbol,
comparing at most one symbol or block a level, and walks down again to the
first difference.  All queries of a call go side by side.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BLOCK, PAIR = 0, 1


@dataclass(frozen=True)
class Level:
    """Symbols of one level; for every level but the last, how they group
    into those of the next: the rule's kind, each one's parent, whether it is
    its parent's first, and the first child of each parent (with a stop)."""

    symbols: np.ndarray
    kind: int = -1
    parent: np.ndarray | None = None
    starts: np.ndarray | None = None
    first: np.ndarray | None = None

    def mirrored(self) -> Level:
        if self.kind < 0:
            return Level(self.symbols[::-1])
        n, m = len(self.symbols), len(self.first) - 1
        first = n - self.first[::-1]
        starts = np.zeros(n, dtype=bool)
        starts[first[:-1]] = True
        return Level(self.symbols[::-1], self.kind, (m - 1 - self.parent)[::-1], starts, first)


def _side(symbols: np.ndarray, salt: int) -> np.ndarray:
    """Left (False) or right (True) half of the alphabet, by a mixing hash."""
    x = symbols.astype(np.uint64) + np.uint64(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(63)).astype(bool)


def _next(symbols: np.ndarray, starts: np.ndarray, names: np.ndarray, kind: int) -> tuple[Level, np.ndarray]:
    first = np.flatnonzero(starts)
    level = Level(symbols, kind, (np.cumsum(starts) - 1).astype(np.int32), starts,
                  np.append(first, len(symbols)).astype(np.int32))
    return level, names


def _named(keys: np.ndarray, upto: int) -> np.ndarray:
    """Fresh symbols ``upto``, ``upto`` + 1, ... for the distinct keys."""
    return np.unique(keys, return_inverse=True)[1].astype(np.int64) + upto


def compress(symbols: np.ndarray, fixed: np.ndarray) -> list[Level]:
    """The levels of a sequence of symbols 0, 1, ....  ``fixed`` marks the
    separators: each must be a symbol of its own; they are never merged.  The
    sequence starts and ends with one.  Ends when every stretch between
    separators is one symbol."""
    seq, fixed = np.asarray(symbols, dtype=np.int64), np.asarray(fixed, dtype=bool)
    upto, levels, salt = int(seq.max()) + 1, [], 0
    while True:
        # blocks
        starts = np.ones(len(seq), dtype=bool)
        starts[1:] = seq[1:] != seq[:-1]
        if not starts.all():
            first = np.flatnonzero(starts)
            size = np.diff(np.append(first, len(seq)))
            names = seq[first]
            long = np.flatnonzero(size > 1)
            names[long] = _named(names[long] * np.int64(len(seq) + 1) + size[long], upto)
            level, nxt = _next(seq, starts, names, BLOCK)
            levels.append(level)
            seq, fixed, upto = nxt, fixed[first], int(names.max()) + 1
        if not np.any(~fixed[1:] & ~fixed[:-1]):
            return [*levels, Level(seq)]
        # pairs; a split that catches nothing is tried again
        salt += 1
        right = _side(seq, salt)
        second = np.zeros(len(seq), dtype=bool)
        second[1:] = right[1:] & ~right[:-1] & ~fixed[1:] & ~fixed[:-1]
        if not second.any():
            continue
        starts = ~second
        first = np.flatnonzero(starts)
        names = seq[first]
        at = np.flatnonzero(second)
        pair = _named(seq[at - 1] * np.int64(upto) + seq[at], upto)
        names[(np.cumsum(starts) - 1)[at]] = pair
        level, nxt = _next(seq, starts, names, PAIR)
        levels.append(level)
        seq, fixed, upto = nxt, fixed[first], int(pair.max()) + 1


def mirrored(levels: list[Level]) -> list[Level]:
    """The levels of the reversed sequence, as the same grammar cuts it."""
    return [x.mirrored() for x in levels]


def extensions(levels: list[Level], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols agree from places ``a`` and ``b`` (a < b, in one
    stretch between separators) onwards."""
    x, y = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
    stopped = np.full(len(x), len(levels) - 1)
    live = np.arange(len(x))
    for h, level in enumerate(levels[:-1]):
        if not len(live):
            break
        p, q = x[live], y[live]
        # not both at a parent's start: the rest of that parent is compared
        inside = np.flatnonzero(~(level.starts[p] & level.starts[q]))
        stop = np.zeros(len(live), dtype=bool)
        if len(inside):
            step, ends = _compare(level, p[inside], q[inside])
            p[inside] += step
            q[inside] += step
            stop[inside] = ends
        x[live], y[live] = p, q
        stopped[live[stop]] = h
        live = live[~stop]
        x[live], y[live] = level.parent[x[live]], level.parent[y[live]]
    # both stand before different symbols of the level where they stopped
    for h in range(len(levels) - 2, -1, -1):
        live = np.flatnonzero(stopped > h)
        if len(live):
            level = levels[h]
            p, q = level.first[x[live]].astype(np.int64), level.first[y[live]].astype(np.int64)
            step, _ = _compare(level, p, q)
            x[live], y[live] = p + step, q + step
    return x - a


def _compare(level: Level, p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols that agree within the parents of p and q, and whether the
    extension ends behind them on this level."""
    same = level.symbols[p] == level.symbols[q]
    if level.kind == PAIR:
        return same.astype(np.int64), ~same
    m, n = level.first[level.parent[p] + 1] - p, level.first[level.parent[q] + 1] - q
    return np.where(same, np.minimum(m, n), 0), ~same | (m != n)
