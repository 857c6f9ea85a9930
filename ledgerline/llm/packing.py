"""Best-fit decreasing packing of token sequences into windows.

A document's ids are first cut into full windows and a rest.  A task packs the
rests of a bounded buffer by falling length, each into the open window with
the least capacity that still holds it; a segment tree over capacities finds
it.  Windows that stay more than ``tolerance`` short are filled by cutting
rests of the emptiest ones, so a buffer leaves at most one open window, whose
pieces go to the next buffer.  What is left of all tasks is packed again, by
fewer tasks each time; the last window of all is cut at powers of two, which
need no padding.  Full windows are written where they are made: only the
few left pieces ever move.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.chunked_tokenizer import read_spec
from ledgerline.llm.common import batch_of, map_arrow, saved, texts_of
from ledgerline.llm.word_encoder import encoder_for

# tokens that a task packs together, and that a later round gives each task
BUFFER_TOKENS = 4_000_000
# windows of one output batch
BATCH_WINDOWS = 512


class CapacityTree:
    """Which capacities 1 .. size occur among the open windows: a segment
    tree of counts; ``tightest`` is the least that occurs from a need on."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, by: int = 1) -> None:
        i = capacity + self.leaves
        while i:
            self.count[i] += by
            i >>= 1

    def tightest(self, need: int) -> int | None:
        count, i = self.count, need + self.leaves
        if not count[i]:
            while not (i & 1 == 0 and count[i + 1]):       # up to the first right sibling in use
                i >>= 1
                if i <= 1:
                    return None
            i += 1
            while i < self.leaves:
                i *= 2
                if not count[i]:
                    i += 1
        return i - self.leaves


@dataclass(frozen=True)
class Piece:
    """Ids [start, start + len(ids)) of a document of ``doc_tokens`` ids."""

    doc_id: int | None
    start: int
    doc_tokens: int
    ids: np.ndarray

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return replace(self, ids=self.ids[:at]), replace(self, start=self.start + at, ids=self.ids[at:])


def cut_documents(doc_id: int | None, ids: np.ndarray, window: int) -> list[Piece]:
    """A document as full windows and at most one shorter rest."""
    return [Piece(doc_id, a, len(ids), ids[a:a + window]) for a in range(0, len(ids), window)]


def best_fit_decreasing(pieces: list[Piece], window: int) -> list[list[Piece]]:
    """Windows of pieces, by falling length (ties in the given order)."""
    tree, at, windows = CapacityTree(window), {}, []
    for p in sorted(pieces, key=lambda p: -len(p.ids)):
        room = tree.tightest(len(p.ids))
        if room is None:
            room, w = window, len(windows)
            windows.append([])
        else:
            w = at[room].pop()
            tree.add(room, -1)
        windows[w].append(p)
        if room > len(p.ids):
            at.setdefault(room - len(p.ids), []).append(w)
            tree.add(room - len(p.ids))
    return windows


def fill(windows: list[list[Piece]], window: int, tolerance: int) -> tuple[list[list[Piece]], list[Piece]]:
    """Windows at most ``tolerance`` short, and the pieces of at most one
    more: windows that are shorter take pieces, cut where need be, from the
    emptiest ones."""
    size = lambda w: sum(len(p.ids) for p in w)
    done = [w for w in windows if window - size(w) <= tolerance]
    short = sorted((w for w in windows if window - size(w) > tolerance), key=size, reverse=True)
    lo, hi = 0, len(short) - 1
    while lo < hi:
        taker, room = list(short[lo]), window - size(short[lo])
        while room > tolerance and lo < hi:
            p = short[hi][-1]
            head, rest = p.cut(min(room, len(p.ids)))
            taker.append(head)
            room -= len(head.ids)
            short[hi] = short[hi][:-1] + ([rest] if len(rest.ids) else [])
            if not short[hi]:
                hi -= 1
        if room > tolerance:
            return done, taker
        done.append(taker)
        lo += 1
    return done, short[lo] if lo == hi and short else []


def cut_at_powers(pieces: list[Piece]) -> list[list[Piece]]:
    """Windows that together hold the pieces and have lengths that are
    powers of two, longest first."""
    out, rest = [], list(pieces)
    total = sum(len(p.ids) for p in rest)
    for bit in reversed(range(total.bit_length())):
        need = total & (1 << bit)
        if need:
            w = []
            while need:
                head, tail = rest.pop(0).cut(need)
                w.append(head)
                need -= len(head.ids)
                if len(tail.ids):
                    rest.insert(0, tail)
            out.append(w)
    return out


_PIECES = pa.list_(pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                              ("doc_tokens", pa.int64())]))
_SCHEMA = pa.schema([("sequence_id", pa.int64()), ("pieces", _PIECES), ("ids", pa.binary())])
SEQUENCES = ("sequence_id long, pieces array<struct<doc_id:long,start:long,length:long,doc_tokens:long>>, "
             "ids binary")


def _rows(windows: list[list[Piece]], ids: list[int | None]) -> pa.RecordBatch:
    return batch_of(_SCHEMA, sequence_id=ids,
                    pieces=[[{"doc_id": p.doc_id, "start": p.start, "length": len(p.ids),
                              "doc_tokens": p.doc_tokens} for p in w] for w in windows],
                    ids=[b"".join(p.ids.tobytes() for p in w) for w in windows])


def _pieces(row_pieces: list[dict], ids: np.ndarray) -> Iterator[Piece]:
    at = 0
    for p in row_pieces:
        yield Piece(p["doc_id"], p["start"], p["doc_tokens"], ids[at:at + p["length"]])
        at += p["length"]


def _packer(window: int, tolerance: int, first_id: int, last: bool):
    """A task: an iterator of lists of pieces to batches of rows; rows without
    a sequence id hold what is left."""

    def run(groups: Iterator[list[Piece]]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = first_id + (TaskContext.get().partitionId() << 32)
        held, tokens = [], 0

        def numbered(windows):
            nonlocal number
            for i in range(0, len(windows), BATCH_WINDOWS):
                part = windows[i:i + BATCH_WINDOWS]
                yield _rows(part, list(range(number, number + len(part))))
                number += len(part)

        full: list[list[Piece]] = []
        for group in groups:
            for p in group:
                if len(p.ids) == window:
                    full.append([p])
                    continue
                held.append(p)
                tokens += len(p.ids)
                if tokens >= BUFFER_TOKENS:
                    done, held = fill(best_fit_decreasing(held, window), window, tolerance)
                    tokens = sum(len(p.ids) for p in held)
                    yield from numbered(done)
            if len(full) >= BATCH_WINDOWS:
                yield from numbered(full)
                full = []
        done, held = fill(best_fit_decreasing(held, window), window, tolerance)
        yield from numbered(full + done + (cut_at_powers(held) if last else []))
        if held and not last:
            yield _rows([held], [None])

    return run


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, window: int = 4096, tolerance: int = 8) -> DataFrame:
    """Every document of ``docs`` (doc_id, text), encoded whole with
    ``end_id`` behind it, in sequences of at most ``window`` ids (a power of
    two): sequence_id, pieces (array of doc_id, start in the document, length,
    doc_tokens) and ids (the pieces' ids in that order, packed little-endian in
    the encoder's width).  A sequence is at most ``tolerance`` ids short of the
    window or as long as a power of two.

    NULL and empty texts are the end id alone; repeated rows are packed as
    often as they occur and NULL ids stay NULL; other columns are not read;
    empty input gives no sequence.  A text of any length is cut into windows as
    it is read; a task holds one buffer of ``BUFFER_TOKENS`` ids and the ids of
    one batch of texts.
    """
    if window < 1 or window & (window - 1) or not 0 <= tolerance < window:
        raise ValueError("the window must be a power of two and the tolerance less")
    spark = docs.sparkSession
    spec = read_spec(tokenizer_path)
    dtype = encoder_for(spec).dtype
    shipped = spark.sparkContext.broadcast(spec)

    def first_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder_for(shipped.value)
        end = np.array([end_id], dtype=enc.dtype)

        def groups():
            for b in batches:
                for i, packed in zip(b.column("doc_id").to_pylist(), enc.encode(texts_of(b))):
                    yield cut_documents(i, np.append(enc.ids(packed), end), window)

        return _packer(window, tolerance, 0, False)(groups())

    def later_round(number: int, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            groups = (list(_pieces(p, np.frombuffer(x, dtype)))
                      for b in batches for p, x in zip(b.column("pieces").to_pylist(), b.column("ids").to_pylist()))
            return _packer(window, tolerance, number << 56, last)(groups)
        return run

    table = saved(map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), first_round,
                            SEQUENCES), "packed")
    out, number = table.filter("sequence_id is not null"), 0
    while True:
        left = table.filter("sequence_id is null")
        tasks, tokens = left.agg(F.count(F.lit(1)), F.sum(F.octet_length("ids"))).first()
        if not tasks:
            return out
        number += 1
        # a task leaves less than one window, so the rest shrinks about a thousandfold a round
        parts = -(-tokens // (dtype.itemsize * BUFFER_TOKENS))
        dealt = left.repartitionByRange(parts, F.xxhash64("pieces")) if parts > 1 else left.coalesce(1)
        table = saved(map_arrow(dealt.sortWithinPartitions(F.xxhash64("pieces"), "ids"),
                                later_round(number, parts == 1), SEQUENCES), "packed")
        out = out.unionByName(table.filter("sequence_id is not null"))


def piece_rows(sequences: DataFrame) -> DataFrame:
    """The pieces of packed sequences, one row each, read from the sequences'
    own ids: doc_id, start, length, ids_crc32 (of the ids as little-endian
    unsigned 32-bit integers), doc_tokens, sequence_id, offset."""
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                                  "sequence_id", "offset")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for s, pieces, x in zip(*(b.column(c).to_pylist() for c in ("sequence_id", "pieces", "ids"))):
                total = sum(p["length"] for p in pieces)
                if len(x) not in (2 * total, 4 * total):
                    raise ValueError(f"sequence {s}: its ids do not match its pieces")
                at, ids = 0, np.frombuffer(x, f"<u{len(x) // total}").astype("<u4")
                for p in pieces:
                    rows.append((p["doc_id"], p["start"], p["length"],
                                 zlib.crc32(ids[at:at + p["length"]].tobytes()), p["doc_tokens"], s, at))
                    at += p["length"]
            yield batch_of(schema, **dict(zip(schema.names, zip(*rows)))) if rows else \
                batch_of(schema, **{c: [] for c in schema.names})

    return map_arrow(sequences.select("sequence_id", "pieces", "ids"), run,
                     ", ".join(f"{c} long" for c in schema.names))
