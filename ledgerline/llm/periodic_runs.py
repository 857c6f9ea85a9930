"""Runs: maximal stretches of a text's words that repeat with a period.

For each period q a grid of places is fine enough that every long run with
that period holds a grid place i with word i equal to word i + q; over all q
the grids have harmonically many places.  The recompression grammar of the
words answers how far each such pair extends to both sides, which gives the
run exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import recompression
from ledgerline.llm.common import batch_of, map_arrow, texts_of

# words of the documents that share one grammar; a longer document has its own
GROUP_WORDS = 150_000
QUERIES = 500_000                 # extensions asked for together


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the whole text."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def _candidates(seq: np.ndarray, doc: np.ndarray, reach: np.ndarray, least: int, times: int) -> Iterator[tuple]:
    """Pairs (i, period) on the grids, in portions: ``reach[q]`` is the end of
    the documents of at least ``times`` * q words, which come first."""
    places, periods, held = [], [], 0
    for q in range(1, len(reach)):
        i = np.arange(0, reach[q] - q, max(least, times * q) - q)
        i = i[seq[i] == seq[i + q]]
        i = i[doc[i] == doc[i + q]]
        if len(i):
            places.append(i)
            periods.append(np.full(len(i), q))
            held += len(i)
        if held >= QUERIES:
            yield np.concatenate(places), np.concatenate(periods)
            places, periods, held = [], [], 0
    if held:
        yield np.concatenate(places), np.concatenate(periods)


def runs_of(docs: list[list[bytes]], least: int = 6, times: int = 4) -> list[np.ndarray]:
    """Per list of words an array of rows (start, length, period), sorted:
    the maximal stretches with smallest period q of at least ``least`` and
    ``times`` * q words."""
    out = [np.empty((0, 3), dtype=np.int64)] * len(docs)
    order = [k for k in sorted(range(len(docs)), key=lambda k: -len(docs[k])) if len(docs[k]) >= least]
    if not order:
        return out
    size = np.array([len(docs[k]) for k in order])
    begin = np.cumsum(np.append(1, size[:-1] + 1))           # a separator before each document
    total = int(begin[-1] + size[-1] + 1)
    codes: dict[bytes, int] = {}
    for k in order:
        for w in docs[k]:
            codes.setdefault(w, len(codes))
    seq, fixed = np.empty(total, dtype=np.int64), np.zeros(total, dtype=bool)
    for at, n, k in zip(begin, size, order):
        seq[at:at + n] = np.fromiter(map(codes.__getitem__, docs[k]), np.int64, n)
    bars = np.append(begin - 1, total - 1)
    seq[bars], fixed[bars] = len(codes) + np.arange(len(bars)), True
    doc = np.repeat(np.arange(len(order) + 1), np.append(size + 1, 1))
    # documents come by falling length: those of >= times * q words end here
    enough = np.searchsorted(-size, -times * np.arange(1, size[0] // times + 1), side="right")
    ends = np.append(0, begin + size)
    reach = np.append(0, ends[enough])

    levels = recompression.compress(seq, fixed)
    back = recompression.mirrored(levels)
    found = []
    for i, q in _candidates(seq, doc, reach, least, times):
        ahead = recompression.extensions(levels, i, i + q)
        # leftwards from i - 1 and i + q - 1, as places of the reversed sequence
        behind = recompression.extensions(back, total - (i + q), total - i)
        start, length = i - behind, behind + q + ahead
        keep = length >= np.maximum(least, times * q)
        found.append(np.unique(np.column_stack([start, length, q])[keep], axis=0))
    rows = np.concatenate(found) if found else np.empty((0, 3), dtype=np.int64)
    if not len(rows):
        return out
    # one stretch may turn up with multiples of its period: the least counts
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    rows = rows[np.append(True, np.any(rows[1:, :2] != rows[:-1, :2], axis=1))]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    owner = doc[rows[:, 0]]
    for d in np.unique(owner):
        own = rows[np.searchsorted(owner, d):np.searchsorted(owner, d, side="right")].copy()
        own[:, 0] -= begin[d]
        out[order[d]] = own
    return out


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words stay if each run shrinks to its first period; runs
    may overlap."""
    edges = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edges)[:n] == 0


def _groups(docs: list[list[bytes]]) -> Iterator[tuple[int, int]]:
    start = held = 0
    for i, w in enumerate(docs):
        if held and held + len(w) > GROUP_WORDS:
            yield start, i
            start, held = i, 0
        held += len(w)
    if start < len(docs):
        yield start, len(docs)


def periodic_runs(docs: DataFrame, least: int = 6, times: int = 4,
                  prepare: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, runs
    (array of start, length, period, by start and period) and collapsed (the
    words that are left if of every run only its first period stays, joined by
    one space).  ``prepare`` may change a document's words before the search.

    NULL and empty texts have no words, no runs and an empty collapsed text;
    repeated rows and NULL ids keep their rows; other columns are not read;
    empty input gives no rows.  Memory grows with a batch of texts and with
    the longest document (about 100 bytes a word), not with the table.
    """
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", run_type),
                        ("collapsed", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("doc_id").to_pylist()
            words = [words_of(t) for t in texts_of(b)]
            if prepare:
                words = [prepare(i, w) for i, w in zip(ids, words)]
            for lo, hi in _groups(words):
                part = words[lo:hi]
                runs = runs_of(part, least, times)
                ends = np.cumsum([0] + [len(r) for r in runs])
                flat = np.concatenate(runs)
                texts = [b" ".join(w if not len(r) else [w[k] for k in np.flatnonzero(kept_words(len(w), r))])
                         for w, r in zip(part, runs)]
                yield batch_of(
                    schema, doc_id=ids[lo:hi], n_words=[len(w) for w in part],
                    runs=pa.ListArray.from_arrays(
                        pa.array(ends, pa.int32()),
                        pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)],
                                                   fields=list(run_type.value_type))),
                    collapsed=[t.decode("utf-8", "replace") for t in texts])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run,
                     "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, "
                     "collapsed string")
