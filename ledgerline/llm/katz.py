"""Language-model scores by Katz backoff over words.

Good-Turing discounted bigram counts back off to Good-Turing discounted
unigram counts, with exactly normalised weights:

    P(w)   = d(c(w)) c(w) / (N + 1)                  c(w) > 0
             what is left                            the unknown word
    P(w|h) = d(c(h,w)) c(h,w) / (c(h) + 1)           c(h,w) > 0
             a(h) P(w)                               otherwise

(the 1 in the denominators keeps something to back off with where no count is
small).  Both levels cover every training word and every pair seen in
training.  The score of a text is summed in three parts,

    log P(w) + log a(h) of each token
    log P(w|h) - log P(w) - log a(h) of each token whose pair was seen

so that words, histories and pairs are each answered where they are stored.
The ``HEAD_WORDS`` most frequent words are also kept in each task, which
answers them itself and spreads their pairs by the pair's hash instead of by
their own; the head decides nothing about what is counted.

Words, backoff weights and pairs live in tables partitioned by a hash of the
word, the history or the pair; a pair is known by a 64-bit hash.  Documents are
read in blocks; a block asks each partition for the words and pairs that it
holds, and the partition answers with sums per document, so neither texts nor
the model are gathered anywhere.  The blocks of a task are numbered in
reading order: the input must be a deterministic read, such as a table.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import (batch_of, free_finished_shuffles, map_arrow, saved, shuffle_partitions,
                                   texts_of)
from ledgerline.session import scratch_table

HEAD_WORDS = 65_000
MAX_DISCOUNTED = 5
BLOCK_TOKENS, BLOCK_DOCS = 1_200_000, 60_000
CACHE_WORDS = 250_000
LEAST_BUCKETS = 24
MERGE_PAIRS = 500_000
END = np.uint64(xxhash.xxh3_64_intdigest(b"\n"))        # no word holds white space
START = np.uint64(xxhash.xxh3_64_intdigest(b"\n\n"))
COUNTS, SUMS, ASK_WORDS, ASK_PAIRS, LOCAL = range(5)


# --- packing --------------------------------------------------------------------

def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays compressed byte by byte: first the lowest bytes of all values,
    and so on, so that the empty upper bytes cost nothing."""
    head = struct.pack(f"<B{len(arrays)}Q", len(arrays), *(a.nbytes for a in arrays))
    planes = (np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(planes))


def _unpack(blob: bytes, *dtypes: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    sizes = struct.unpack_from(f"<{raw[0]}Q", raw, 1)
    out, at = [], 1 + 8 * raw[0]
    for size, t in zip(sizes, dtypes):
        width = np.dtype(t).itemsize
        planes = np.frombuffer(raw, np.uint8, size, at).reshape(width, size // width)
        out.append(np.ascontiguousarray(planes.T).view(t).reshape(size // width))
        at += size
    return out


def _deltas(sorted_keys: np.ndarray) -> np.ndarray:
    return np.diff(sorted_keys, prepend=sorted_keys.dtype.type(0))


def _keys(deltas: np.ndarray) -> np.ndarray:
    return np.cumsum(deltas, dtype=deltas.dtype)


def _merge(parts: list[tuple[np.ndarray, np.ndarray]], dtype) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with their summed counts."""
    if not parts:
        return np.empty(0, dtype), np.empty(0, np.int64)
    keys = np.concatenate([k for k, _ in parts])
    counts = np.concatenate([c for _, c in parts]).astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, int)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def bucket_of(key: np.ndarray, n: int) -> np.ndarray:
    return ((key >> np.uint64(33)) % np.uint64(n)).astype(np.int64)


def pair_key(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """64-bit hash of (history, word), both hashes themselves."""
    return h * np.uint64(0x9E3779B97F4A7C15) + w * np.uint64(0xC2B2AE3D27D4EB4F)


def _dealt(at: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Places in the order of their buckets, those of a bucket ascending, and
    each bucket with its span of that order; small bucket numbers sort by
    digits."""
    small = at.astype(np.uint16) if len(at) and at.max() < 1 << 16 else at
    order = np.argsort(small, kind="stable")
    by = at[order]
    first = np.flatnonzero(np.concatenate([[True], by[1:] != by[:-1]])) if len(by) else np.empty(0, np.int64)
    ends = np.append(first[1:], len(by))
    return order, list(zip(by[first].tolist(), first.tolist(), ends.tolist()))


def _parts(at: np.ndarray, *arrays: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The arrays' values by bucket."""
    order, spans = _dealt(at)
    arrays = [a[order] for a in arrays]
    for k, i, j in spans:
        yield k, [a[i:j] for a in arrays]


def _squeeze(m: Model, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes as head ids, and the hashes of those not in the head."""
    ids = np.minimum(m.ids(hashes), len(m.head))
    return ids.astype("<u4"), hashes[ids == len(m.head)]


def _restore(m: Model, ids: np.ndarray, rare: np.ndarray) -> np.ndarray:
    out = np.append(m.head, np.uint64(0))[ids]
    out[ids == len(m.head)] = rare
    return out


def _pack_pairs(m: Model, h: np.ndarray, w: np.ndarray, c: np.ndarray, of_word: np.ndarray | None = None) -> bytes:
    """Pairs sorted by history, with counts; each word's hash (and value
    ``of_word``) is kept once."""
    own_h, h_at = np.unique(h, return_inverse=True)
    own_w, w_at = np.unique(w, return_inverse=True)
    place = np.empty(len(own_w), np.int64)
    place[w_at] = np.arange(len(w))                         # any of the word's
    order = np.argsort(h_at << 32 | w_at)
    more = [] if of_word is None else [of_word[place].astype("<i8")]
    return _pack(*_squeeze(m, own_h), np.bincount(h_at).astype("<u4"), *_squeeze(m, own_w), w_at[order].astype("<u4"),
                 c[order].astype("<i8"), *more)


def _unpack_pairs(m: Model, blob: bytes) -> list[np.ndarray]:
    """History, word and count of each pair, and the word's value if kept."""
    h, rare_h, times, w, rare_w, at, c, *more = _unpack(blob, "<u4", "<u8", "<u4", "<u4", "<u8", "<u4", "<i8", "<i8")
    return [np.repeat(_restore(m, h, rare_h), times), _restore(m, w, rare_w)[at], c, *(x[at] for x in more)]


# --- blocks of documents ----------------------------------------------------------

class _Codes(dict):
    def __init__(self):
        super().__init__()
        self.hashes: list[int] = []

    def __missing__(self, word):
        v = self[word] = len(self.hashes)
        self.hashes.append(xxhash.xxh3_64_intdigest(word))
        return v


class Block:
    """Tokens of a run of documents: a code per token into ``table`` of word
    hashes (END behind each document), document of each token, and whether it
    is trained on."""

    def __init__(self, codes: _Codes, docs: list[np.ndarray], train: list[bool]):
        self.table = np.array([*codes.hashes, END], dtype=np.uint64)
        lens = np.array([len(d) for d in docs], dtype=np.int64) + 1
        ends = np.cumsum(lens) - 1
        self.code = np.full(int(lens.sum()), len(self.table) - 1, np.int32)
        inner = np.ones(len(self.code), bool)
        inner[ends] = False
        self.code[inner] = np.concatenate(docs)
        self.doc = np.repeat(np.arange(len(docs), dtype=np.int32), lens)
        self.starts = ends - lens + 1
        self.lens, self.train = lens, np.array(train, dtype=bool)

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted hashes of the training words, and their counts."""
        n = np.bincount(self.code[self.train[self.doc]], minlength=len(self.table))
        own = np.flatnonzero(n)
        order = own[np.argsort(self.table[own])]
        return self.table[order], n[order]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of history and word per code, START last; the history of each
        token and a code of its pair (history, word)."""
        table = np.append(self.table, START)
        h = np.empty_like(self.code)
        h[1:] = self.code[:-1]
        h[self.starts] = len(self.table)
        return table, h, h.astype(np.int64) * len(table) + self.code


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, list, list]]:
    """(block, doc ids, held out) of batches with doc_id, text, train."""
    codes, docs, ids, train, size = _Codes(), [], [], [], 0
    for b in batches:
        for d, t, tr in zip(b.column("doc_id").to_pylist(), texts_of(b), b.column("train").to_pylist()):
            w = t.encode("utf-8", "surrogatepass").lower().split()
            docs.append(np.fromiter(map(codes.__getitem__, w), np.int32, len(w)))
            ids.append(d)
            train.append(tr)
            size += len(w) + 1
            if size >= BLOCK_TOKENS or len(docs) >= BLOCK_DOCS:
                yield Block(codes, docs, train), ids, train
                docs, ids, train, size = [], [], [], 0
                if len(codes) > CACHE_WORDS:
                    codes = _Codes()
    if docs:
        yield Block(codes, docs, train), ids, train


# --- Good-Turing ------------------------------------------------------------------

def discounts(n_r: np.ndarray) -> np.ndarray:
    """d(0..MAX_DISCOUNTED) from the numbers n_r[r] of types seen r times, r up
    to MAX_DISCOUNTED + 1; Katz's formula with the largest bound k for which it
    gives values in (0, 1], else absolute discounting by one half."""
    d = np.ones(MAX_DISCOUNTED + 1)
    for k in range(MAX_DISCOUNTED, 1, -1):
        if not (n_r[1:k + 2] > 0).all():
            continue
        tail = (k + 1) * n_r[k + 1] / n_r[1]
        r = np.arange(1, k + 1)
        v = ((r + 1) * n_r[2:k + 2] / (r * n_r[1:k + 1]) - tail) / (1 - tail) if tail != 1 else np.zeros(k)
        if ((v > 0) & (v <= 1)).all():
            d[1:k + 1] = v
            return d
    r = np.arange(1, MAX_DISCOUNTED + 1)
    d[1:] = (r - 0.5) / r
    return d


def discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    c = np.asarray(counts, dtype=np.int64)
    return c * d[np.where(c <= MAX_DISCOUNTED, c, 0)]


class Model:
    """What every task needs: the head's words and the smoothing; its size is
    bounded by HEAD_WORDS."""

    def __init__(self, head: np.ndarray, counts: np.ndarray, tokens: int, types: int, docs: int,
                 n_r: np.ndarray, buckets: int):
        self.head, self.tokens, self.types, self.docs, self.buckets = head, tokens, types, docs, buckets
        self.d1 = discounts(n_r)
        small = np.arange(1, MAX_DISCOUNTED + 1)
        kept = tokens - (small * n_r[1:-1] * (1 - self.d1[1:])).sum()
        self.unknown = 1 - kept / (tokens + 1)
        # history counts: head words, the start of a document; 0 for the others
        self.counts = counts.astype(np.int64)
        self.history = np.concatenate([counts, [docs, 0]]).astype(np.float64)
        self.start, self.tail = len(head), len(head) + 1
        self.logs1 = self.word_logs(self.counts)
        self.d2, self.backoff = np.ones(MAX_DISCOUNTED + 1), np.ones(len(head) + 2)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Head ids; ``start`` for START and ``tail`` for other words."""
        other = np.where(hashes == START, self.start, self.tail)
        if not len(self.head):
            return other
        at = np.minimum(np.searchsorted(self.head, hashes), len(self.head) - 1)
        return np.where(self.head[at] == hashes, at, other)

    def word_logs(self, counts: np.ndarray) -> np.ndarray:
        return np.log10(np.where(counts > 0, discounted(counts, self.d1) / (self.tokens + 1), self.unknown))

    def pair_buckets(self, h_ids: np.ndarray, h: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Where a pair is stored: with its history, or by its own hash if the
        history is in the head."""
        return bucket_of(np.where(h_ids == self.tail, h, key), self.buckets)

    def weights(self, mass: np.ndarray, below: np.ndarray, count: np.ndarray) -> np.ndarray:
        """a(h): the mass that the seen pairs leave, over that of the words not
        seen behind h."""
        return (1 - mass / (count + 1)) / np.maximum(1 - below, self.unknown)


# --- training ------------------------------------------------------------------------

def _grade(counts: np.ndarray) -> np.ndarray:
    """Count, exactly up to 64 and in steps of a sixteenth of an octave above."""
    return np.where(counts <= 64, counts, (np.log2(np.maximum(counts, 1)) * 16).astype(np.int64))


_ROWS = "bucket int, kind int, block long, payload binary"
_ROWS_ARROW = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("block", pa.int64()), ("payload", pa.binary())])


def _by_bucket(df: DataFrame) -> DataFrame:
    return df.repartition("bucket").sortWithinPartitions("bucket", "kind", "block")


def _docs(docs: DataFrame, train) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", train.alias("train"))


def _reduce(rows: DataFrame, key: str, extra: str, summary) -> DataFrame:
    """Sum the count rows of each bucket into one (bucket, payload) row with
    what ``summary(keys, counts)`` adds to it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []

        def close():
            keys, counts = _merge(held, key)
            add = summary(keys, counts)
            return pa.RecordBatch.from_pydict({
                "bucket": pa.array([bucket], pa.int32()),
                "payload": pa.array([_pack(_deltas(keys), counts.astype("<i8"))], pa.binary()), **add})

        for b in batches:
            for k, p in zip(b.column("bucket").to_pylist(), b.column("payload").to_pylist()):
                if k != bucket:
                    if held:
                        yield close()
                    bucket, held = k, []
                d, c = _unpack(p, key, "<i8")
                held.append((_keys(d), c))
                if len(held) >= 64:
                    held = [_merge(held, key)]
        if held:
            yield close()

    return map_arrow(_by_bucket(rows), run, f"bucket int, payload binary, {extra}")


def _word_counts(docs: DataFrame, buckets: int) -> DataFrame:
    """The training words' counts, by bucket."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, _, _ in blocks(batches):
            h, n = b.counted()
            for k, (own, times) in _parts(bucket_of(h, buckets), h, n):
                yield batch_of(_ROWS_ARROW, bucket=[k], kind=[COUNTS], block=[0],
                               payload=[_pack(_deltas(own), times.astype("<i8"))])

    def summary(keys, counts):
        grade, n = np.unique(_grade(counts), return_counts=True)
        ends = counts[np.searchsorted(keys, END)] if len(keys) and END in keys else 0
        return {"tokens": pa.array([int(counts.sum())]), "types": pa.array([len(keys)]), "docs": pa.array([int(ends)]),
                "grades": pa.array([grade.tolist()], pa.list_(pa.int64())), "sizes": pa.array([n.tolist()], pa.list_(pa.int64()))}

    rows = map_arrow(docs.filter("train"), count, _ROWS)
    return _reduce(rows, "<u8", "tokens long, types long, docs long, grades array<long>, sizes array<long>", summary)


def _head(words: DataFrame, grades: dict[int, int], limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent words, whole grades of counts, at most ``limit``."""
    left, least = limit, 1 << 62
    for g in sorted(grades, reverse=True):
        left -= grades[g]
        if left < 0:
            break
        least = g

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("h", pa.int64()), ("n", pa.int64())])
        for b in batches:
            for p in b.column("payload").to_pylist():
                d, c = _unpack(p, "<u8", "<i8")
                own = _grade(c) >= least
                yield batch_of(schema, h=_keys(d)[own].view(np.int64), n=c[own])

    rows = map_arrow(words.select("payload"), pick, "h long, n long").toPandas()
    h, n = rows["h"].to_numpy(np.int64).view(np.uint64), rows["n"].to_numpy(np.int64)
    order = np.argsort(h)
    return h[order], n[order]


def _add_pairs(parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (history, word) with their summed counts."""
    h, w, c = (np.concatenate(x) for x in zip(*parts))
    key = pair_key(h, w)
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return h[order[first]], w[order[first]], np.add.reduceat(c[order], first)


def _pair_counts(docs: DataFrame, words: DataFrame, model: Model) -> DataFrame:
    """Table of the training pairs' counts beside their words' (COUNTS), in the
    buckets of Model.pair_buckets, with the sums of the head's histories
    (SUMS).  Pairs are summed where their word's count is: with the word, or
    anywhere (by their own hash) if it is in the head."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        for b, _, _ in blocks(batches):
            table, _, code = b.pairs()
            code, n = np.unique(code[b.train[b.doc]], return_counts=True)
            h, at = table[code // len(table)], code % len(table)
            w = table[at]
            to = bucket_of(np.where((m.ids(table) == m.tail)[at], w, pair_key(h, w)), m.buckets)
            for k, x in _parts(to, h, w, n):
                yield batch_of(_ROWS_ARROW, bucket=[k], kind=[SUMS], block=[0], payload=[_pack_pairs(m, *x)])

    schema = pa.schema([*_ROWS_ARROW, ("n_r", pa.list_(pa.int64()))])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, bucket, held, keys, counts = shipped.value, None, [], None, None

        def close():
            h, w, c = _add_pairs(held)
            w_ids, h_ids = m.ids(w), m.ids(h)
            n = np.append(m.counts, [0, 0])[w_ids]
            rare = w_ids == m.tail
            if rare.any():
                n[rare] = counts[np.searchsorted(keys, w[rare])]
            for k, x in _parts(m.pair_buckets(h_ids, h, pair_key(h, w)), h, w, c, n):
                yield batch_of(schema, bucket=[k], kind=[COUNTS], block=[bucket], payload=[_pack_pairs(m, *x)], n_r=[None])
            common = h_ids != m.tail
            own, at = np.unique(h_ids[common], return_inverse=True)
            c_own, grade = c[common], np.minimum(c[common], MAX_DISCOUNTED + 1)
            sums = [np.bincount(at, np.where(grade == r, c_own, 0), len(own)) for r in range(1, MAX_DISCOUNTED + 2)]
            below = np.bincount(at, 10.0 ** m.word_logs(n[common]), len(own))
            n_r = np.bincount(np.minimum(c, MAX_DISCOUNTED + 2), minlength=MAX_DISCOUNTED + 2)[:MAX_DISCOUNTED + 2]
            yield batch_of(schema, bucket=[bucket], kind=[SUMS], block=[bucket],
                           payload=[_pack(own.astype("<i8"), below, *sums)], n_r=[n_r.tolist()])

        for b in batches:
            for k, kind, p in zip(*(b.column(x).to_pylist() for x in ("bucket", "kind", "payload"))):
                if k != bucket:
                    if held:
                        yield from close()
                    bucket, held, keys, counts = k, [], np.empty(0, "<u8"), np.empty(0, np.int64)
                if kind == COUNTS:
                    d, counts = _unpack(p, "<u8", "<i8")
                    keys = _keys(d)
                    continue
                held.append(_unpack_pairs(m, p))
                if sum(len(x[0]) for x in held[1:]) >= len(held[0][0]) + MERGE_PAIRS:
                    held = [_add_pairs(held)]
        if held:
            yield from close()

    stored = words.select("bucket", F.lit(COUNTS).alias("kind"), F.lit(0).cast("long").alias("block"), "payload")
    rows = map_arrow(docs.filter("train"), count, _ROWS).unionByName(stored)
    return saved(map_arrow(_by_bucket(rows), add, f"{_ROWS}, n_r array<long>"), "katz-pairs")


class _Table:
    """One bucket of the model: its words outside the head with count and
    log a, and its pairs with log P(w|h) - log P(w) - log a(h)."""

    def __init__(self, m: Model, parts: list):
        h, w, c, n = (np.concatenate(x) for x in zip(*parts)) if parts else (np.empty(0, t) for t in ("<u8", "<u8", "<i8", "<i8"))
        ids, mass, log1 = m.ids(h), discounted(c, m.d2), m.word_logs(n)
        rare = ids == m.tail
        self.words, at = np.unique(h[rare], return_inverse=True)
        size = len(self.words)
        self.counts = np.bincount(at, c[rare], size).astype(np.int64)
        self.log_a = np.log10(m.weights(np.bincount(at, mass[rare], size), np.bincount(at, 10.0 ** log1[rare], size), self.counts))
        gain = np.log10(mass) - log1 - (np.log10(m.history + 1) + np.log10(m.backoff))[ids]      # 0 outside the head
        gain[rare] -= np.log10(self.counts + 1)[at] + self.log_a[at]
        key = pair_key(h, w)
        order = np.argsort(key)
        self.pairs, self.gain = key[order], gain[order]


def train(docs: DataFrame, train_rows, head_words: int = HEAD_WORDS) -> tuple[Model, DataFrame]:
    """Counts of the rows of ``docs`` (doc_id, text) where the condition
    ``train_rows`` holds: the model and its partitioned table."""
    buckets = max(LEAST_BUCKETS, shuffle_partitions(docs.sparkSession))
    d = _docs(docs, train_rows)
    with scratch_table(_word_counts(d, buckets), "katz-words") as words:     # the pairs bring its counts along
        totals = words.agg(F.sum("tokens"), F.sum("types"), F.sum("docs")).first()
        tokens, types, n_docs = (int(x or 0) for x in totals)
        grades = {int(r.g): int(r.n) for r in words.select(F.explode(F.arrays_zip("grades", "sizes")).alias("z"))
                  .groupBy(F.col("z.grades").alias("g")).agg(F.sum("z.sizes").alias("n")).collect()}
        n_r = np.array([0] + [grades.get(r, 0) for r in range(1, MAX_DISCOUNTED + 2)], dtype=float)
        head, counts = _head(words, grades, head_words)
        if n_docs and END not in head:                      # the end is no history: always in the head
            at = np.searchsorted(head, END)
            head, counts = np.insert(head, at, END), np.insert(counts, at, n_docs)
        model = Model(head, counts, tokens, types, n_docs, n_r, buckets)
        pairs = _pair_counts(d, words, model)
    got = pairs.select(F.posexplode("n_r").alias("r", "n")).groupBy("r").agg(F.sum("n").alias("n")).collect()
    n_r = np.zeros(MAX_DISCOUNTED + 2)
    for r in got:
        n_r[r.r] = r.n
    model.d2 = discounts(n_r)
    _set_backoff(model, pairs)
    free_finished_shuffles(docs.sparkSession)               # those of the counts
    return model, pairs


def _set_backoff(model: Model, pairs: DataFrame) -> None:
    """a(h) of the head's histories, whose sums come from every partition."""
    names = ["below", *(f"s{r}" for r in range(1, MAX_DISCOUNTED + 2))]
    schema = pa.schema([("h", pa.int64()), *((n, pa.float64()) for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p in b.column("payload").to_pylist():
                h, *sums = _unpack(p, "<i8", *["<f8"] * len(names))
                yield batch_of(schema, h=h, **dict(zip(names, sums)))

    rows = map_arrow(pairs.filter(F.col("kind") == SUMS).select("payload"), run,
                     ", ".join(["h long", *(f"{n} double" for n in names)]))
    sums = rows.groupBy("h").agg(*[F.sum(n).alias(n) for n in names]).toPandas()                # HEAD_WORDS + 2 rows
    h = sums["h"].to_numpy(np.int64)
    mass = sums[names[1:]].to_numpy(float) @ np.append(model.d2[1:], 1.0)
    model.backoff[h] = model.weights(mass, sums["below"].to_numpy(float), model.history[h])


# --- scoring ---------------------------------------------------------------------------

def _request(code: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct codes, their occurrences, the document of each."""
    if len(code) and code.max() >= 1 << 47:                 # of one document of millions of words
        order = np.lexsort((doc, code))
        code, doc = code[order], doc[order].astype("<u2")
    else:
        both = code << 16
        both |= doc
        both.sort()
        doc = (both & 0xFFFF).astype("<u2")
        code = np.right_shift(both, 16, out=both)
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.empty(0, np.int64)
    return code[first], np.diff(np.append(first, len(code))), doc


def _split(at: np.ndarray, times: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Which of the keys go to a bucket, their occurrences and documents."""
    order, spans = _dealt(at)
    doc = doc[_dealt(np.repeat(at, times))[0]]
    times = times[order]
    ends = np.cumsum(times)
    for k, i, j in spans:
        yield k, order[i:j], times[i:j], doc[ends[i] - times[i]:ends[j - 1]]


def _find(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``asked`` in the sorted ``keys``, and whether they are there."""
    if not len(keys):
        return np.zeros(len(asked), np.int64), np.zeros(len(asked), bool)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return at, keys[at] == asked


def score(docs: DataFrame, train_rows, model: Model, pairs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of
    every row of ``docs`` (doc_id, text); NULL is the empty text, whose one
    token is the end."""
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(model)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, part = shipped.value, TaskContext.get().partitionId()
        for seq, (b, doc_ids, _) in enumerate(blocks(batches)):
            block, n = part << 24 | seq, len(doc_ids)
            hashes, h, code = b.pairs()
            ids = m.ids(hashes).astype(np.int32)
            w, h = ids[b.code], ids[h]
            rare, out = w == m.tail, []
            own, times, doc = _request(b.code[rare].astype(np.int64), b.doc[rare])
            for k, x, n_x, d in _split(bucket_of(hashes[own], m.buckets), times, doc):
                out.append((k, ASK_WORDS, _pack(hashes[own[x]], n_x.astype("<u4"), d)))
            own, times, doc = _request(code, b.doc)                  # sorted by history
            del code
            h_at, w_at = own // len(hashes), own % len(hashes)
            key = pair_key(hashes[h_at], hashes[w_at])
            for k, x, n_x, d in _split(m.pair_buckets(ids[h_at], hashes[h_at], key), times, doc):
                first = np.flatnonzero(np.diff(h_at[x], prepend=-1))
                own_w, at = np.unique(w_at[x], return_inverse=True)
                out.append((k, ASK_PAIRS, _pack(*_squeeze(m, hashes[h_at[x[first]]]),
                                                np.diff(np.append(first, len(x))).astype("<u4"),
                                                *_squeeze(m, hashes[own_w]), at.astype("<u4"), n_x.astype("<u4"), d)))
            # what the head answers by itself: its words, and its weights as
            # histories; a rare word brings its weight along
            common = ~rare
            own = np.bincount(b.doc[common], minlength=n)
            base = np.bincount(b.doc[common], np.log10(np.append(m.counts, [0, 0])[w[common]] + 1.0), n)
            base -= b.lens * np.log10(m.tokens + m.types + 1)
            value = np.bincount(b.doc[common], np.append(m.logs1, [0, 0])[w[common]], n)
            value = value + np.bincount(b.doc, np.log10(m.backoff)[h], n)
            valid = np.array([i is not None for i in doc_ids], dtype="u1")
            local = _pack(np.array([i or 0 for i in doc_ids], "<i8"), valid, (~b.train).astype("u1"),
                          b.lens.astype("<i8"), own.astype("<i8"), base.astype("<f8"), value.astype("<f8"))
            out.append((-1 - block % m.buckets, LOCAL, local))
            yield batch_of(_ROWS_ARROW, bucket=[x[0] for x in out], kind=[x[1] for x in out],
                           block=[block] * len(out), payload=[x[2] for x in out])

    answer_schema = pa.schema([("block", pa.int64()), ("i", pa.int32()), ("doc_id", pa.int64()), ("held_out", pa.bool_()),
                               ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("value", pa.float64())])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, bucket = shipped.value, None
        for x in batches:
            for k, kind, block, p in zip(*(x.column(c).to_pylist() for c in ("bucket", "kind", "block", "payload"))):
                if kind == LOCAL:
                    ids, valid, out, n, known, base, value = _unpack(p, "<i8", "u1", "u1", "<i8", "<i8", "<f8", "<f8")
                    yield batch_of(answer_schema, block=np.full(len(ids), block), i=np.arange(len(ids), dtype=np.int32),
                                   doc_id=pa.array(ids, pa.int64(), mask=valid == 0), held_out=out.astype(bool),
                                   n_tokens=n, n_known=known, base=base, value=value)
                    continue
                if k != bucket:
                    bucket, parts, table = k, [], None
                if kind == COUNTS:
                    parts.append(_unpack_pairs(m, p))
                    continue
                if table is None:
                    table, parts = _Table(m, parts), []
                if kind == ASK_PAIRS:
                    h, rare_h, n_h, w, rare_w, at, times, doc = _unpack(
                        p, "<u4", "<u8", "<u4", "<u4", "<u8", "<u4", "<u4", "<u2")
                    h, w = _restore(m, h, rare_h), _restore(m, w, rare_w)
                    at, found = _find(table.pairs, pair_key(np.repeat(h, n_h), w[at]))
                    doc = doc[np.repeat(found, times)]
                    value = np.bincount(doc, np.repeat(table.gain[at[found]], times[found]))
                    known, base = np.zeros(len(value), np.int64), np.zeros(len(value))
                else:
                    asked, times, doc = _unpack(p, "<u8", "<u4", "<u2")
                    at, found = _find(table.words, asked)
                    c, log = np.zeros(len(asked), np.int64), np.zeros(len(asked))
                    c[found], log[found] = table.counts[at[found]], table.log_a[at[found]]
                    value = np.bincount(doc, np.repeat(m.word_logs(c) + log, times))
                    known = np.bincount(doc, np.repeat(c > 0, times)).astype(np.int64)
                    base = np.bincount(doc, np.repeat(np.log10(c + 1.0), times))
                i = np.unique(doc).astype(np.int32)
                none = pa.nulls(len(i), pa.int64())
                yield batch_of(answer_schema, block=np.full(len(i), block), i=i, doc_id=none,
                               held_out=pa.nulls(len(i), pa.bool_()), n_tokens=none,
                               n_known=known[i], base=base[i], value=value[i])

    stored = pairs.filter(F.col("kind") == COUNTS).drop("n_r")
    asked = map_arrow(_docs(docs, train_rows), ask, _ROWS).unionByName(stored)
    answers = map_arrow(_by_bucket(asked), answer,
                        "block long, i int, doc_id long, held_out boolean, n_tokens long, n_known long, base double, value double")
    # the document's own row is the one with its token count
    return answers.groupBy("block", "i").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"), F.sum("base").alias("base_score"), F.sum("value").alias("score")) \
        .select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
                "base_score", "score")


def katz_scores(docs: DataFrame, held_out, head_words: int = HEAD_WORDS) -> DataFrame:
    """Train on the rows of ``docs`` that are not ``held_out`` and score all of
    them; see score().  Without training rows every token is the unknown word,
    with probability 1."""
    train_rows = ~held_out
    model, pairs = train(docs, train_rows, head_words)
    return score(docs, train_rows, model, pairs)
