"""Benchmark decontamination by an FM-index per shard of documents.

A task gathers documents into shards, indexes the words that also occur in
the benchmark (all other words are one separator, and runs shorter than the
shortest test phrase cannot hold one), searches every phrase backwards,
locates the occurrences and merges them into spans per document.  Documents
never move.  The benchmark goes out in blocks of bounded size, one pass each.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import map_arrow, saved
from ledgerline.llm.fm_index import FMIndex

WINDOW = 10
SHARD_WORDS = 1_000_000
BLOCK_BYTES = 4_000_000            # benchmark text in one broadcast
# words are runs of ASCII letters and digits and of non-ASCII bytes; A-Z are
# lower-cased, everything else separates
_WORD = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
_TABLE = bytes(b if b in _WORD else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_ITEMS = pa.list_(pa.string())


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


class Phrases:
    """Distinct windows of a block of benchmark items."""

    def __init__(self, items: list[tuple], window: int):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple, set[str]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                # an item without an id marks words, but has no id to report
                owners.setdefault(tuple(ids[i:i + window]), set()).update(
                    [] if item is None else [str(item)])
        self.lengths = np.array([len(p) for p in owners], dtype=np.int64)
        self.patterns = np.zeros((len(owners), window), dtype=np.int64)
        for row, p in enumerate(owners):
            self.patterns[row, window - len(p):] = p
        self.names = sorted(set().union(*owners.values())) if owners else []
        place = {n: i for i, n in enumerate(self.names)}
        held = [sorted(place[n] for n in o) for o in owners.values()]
        self.owner_at = np.cumsum([0] + [len(h) for h in held])
        self.owner = np.array([i for h in held for i in h], dtype=np.int64)

    def shortest(self) -> int:
        return int(self.lengths.min(initial=1 << 30))


def _long_runs(ids: np.ndarray, least: int) -> np.ndarray:
    """Places of the runs of non-zero ids with at least ``least`` members."""
    edge = np.diff((ids != 0).view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    keep = ends - starts >= least
    mark = np.zeros(len(ids) + 1, dtype=np.int32)
    mark[starts[keep]] = 1
    mark[ends[keep]] -= 1
    return np.flatnonzero(np.cumsum(mark[:-1], out=mark[:-1]))


def occurrences(phrases: Phrases, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pattern, place) of every occurrence in the shard's ids, by its
    FM-index."""
    none = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    places = _long_runs(ids, phrases.shortest()) if len(phrases.lengths) else none[0]
    if not len(places):
        return none
    gap = np.flatnonzero(np.diff(places) > 1) + 1
    text = np.insert(ids[places].astype(np.int64), gap, 0)
    origin = np.insert(places, gap, -1)
    text, origin = np.concatenate([[0], text]), np.concatenate([[-1], origin])
    index = FMIndex(text, len(phrases.vocabulary) + 1)
    lo, hi = index.search(phrases.patterns, phrases.lengths)
    count = np.maximum(hi - lo, 0)
    which = np.repeat(np.arange(len(lo)), count)
    rows = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + lo[which]
    return which, origin[index.locate(rows)]


def _search_shard(phrases: Phrases, docs: list[np.ndarray], old: list) -> tuple[list, list]:
    """Spans and items per document of a shard, merged with those found in
    earlier blocks (``old``: pairs of spans and items)."""
    starts = np.cumsum([0] + [len(d) + 1 for d in docs])
    ids = np.zeros(starts[-1], dtype=np.int32)
    for s, d in zip(starts, docs):
        ids[s:s + len(d)] = d
    which, place = occurrences(phrases, ids)
    mark = np.zeros(len(ids) + 1, dtype=np.int32)
    np.add.at(mark, place, 1)
    np.add.at(mark, place + phrases.lengths[which], -1)
    doc = np.searchsorted(starts, place, side="right") - 1
    found: dict[int, set[str]] = {}
    for d, p in np.unique(np.stack([doc, which]), axis=1).T.tolist() if len(doc) else ():
        own = phrases.owner[phrases.owner_at[p]:phrases.owner_at[p + 1]]
        found.setdefault(d, set()).update(phrases.names[i] for i in own)
    for i, (spans, items) in enumerate(old):
        for s in spans or ():
            mark[starts[i] + s["start"]] += 1
            mark[starts[i] + s["end"]] -= 1
        if items:
            found.setdefault(i, set()).update(items)
    edge = np.diff((np.cumsum(mark, out=mark) > 0).view(np.int8), prepend=np.int8(0))
    a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    spans: list[list] = [[] for _ in docs]
    for d, s, e in zip((np.searchsorted(starts, a, side="right") - 1).tolist(), a.tolist(), b.tolist()):
        spans[d].append({"start": s - int(starts[d]), "end": e - int(starts[d])})
    return spans, [sorted(found.get(i, ())) for i in range(len(docs))]


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> tuple[int, Iterator[list[tuple]]]:
    """How many blocks the benchmark has, and their (id, text) rows one block
    after another."""
    rows = benchmark.select(F.col(item_id).alias("i"), F.col(text).alias("t")).filter(F.col("t").isNotNull())
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-size // BLOCK_BYTES))
    block = F.pmod(F.xxhash64("i", "t"), F.lit(n))
    return n, ([tuple(r) for r in (rows if n == 1 else rows.filter(block == k)).collect()] for k in range(n))


def mark(docs: DataFrame, benchmark: DataFrame, carry: list[str], text: str = "text",
         item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
         shard_words: int = SHARD_WORDS, leave: tuple[Callable, T.StructType] | None = None) -> DataFrame:
    """``carry`` columns of ``docs`` plus n_words, hit_spans (merged word
    ranges [start, end) covered by occurrences of windows) and hit_items (ids,
    as strings, of the items with occurring windows).

    A window is ``window`` consecutive words of an item; an item of fewer, but
    not none, is one window.  NULL or wordless texts have no words; an empty
    benchmark hits nothing; repeated rows are judged each on their own; an
    item row without an id marks words but is not reported.

    ``leave`` (a function and the schema of what it returns) makes other rows
    in the task that marked them: of a batch with ``carry`` and the text as
    _doc_text, and its rows' n_words, hit_spans and hit_items.
    """
    spark = docs.sparkSession
    n_blocks, blocks = _blocks(benchmark, item_id, item_text)
    base = docs.select(*carry, F.col(text).alias("_doc_text"))
    out = base.withColumns({
        "n_words": F.lit(0).cast("long"),
        "hit_spans": F.lit(None).cast("array<struct<start:long,end:long>>"),
        "hit_items": F.lit(None).cast("array<string>")})
    for k, items in enumerate(blocks):
        last = k == n_blocks - 1
        shipped = spark.sparkContext.broadcast(Phrases(items, window))
        if last and leave:
            made, schema = leave
        else:
            keep = out.columns[:-3 - last]
            made = _with_marks(keep)
            schema = T.StructType([out.schema[c] for c in keep] + list(out.schema[-3:]))
        out = map_arrow(out, _pass(shipped, made, shard_words), schema)
        if not last:            # this block's marks are kept, its phrases let go
            out = saved(out, "marks")
            shipped.unpersist()
    return out


def _with_marks(keep: list[str]):
    def made(b: pa.RecordBatch, n_words: list, spans: list, items: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [b.column(c) for c in keep] + [pa.array(n_words, pa.int64()), pa.array(spans, _SPANS),
                                           pa.array(items, _ITEMS)],
            [*keep, "n_words", "hit_spans", "hit_items"])

    return made


def _pass(shipped, made: Callable, shard_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = shipped.value
        get = phrases.vocabulary.get
        held, docs, size = [], [], 0

        def close():
            # a batch may end inside a shard: rows leave with their shard
            old = [p for b in held for p in zip(b.column("hit_spans").to_pylist(),
                                                b.column("hit_items").to_pylist())]
            spans, items = _search_shard(phrases, docs, old)
            at = 0
            for b in held:
                n = b.num_rows
                yield made(b, [len(d) for d in docs[at:at + n]], spans[at:at + n], items[at:at + n])
                at += n

        for b in batches:
            first = 0
            for i, t in enumerate(b.column("_doc_text").to_pylist()):
                w = words_of(t)
                docs.append(np.fromiter(map(get, w, repeat(0)), np.int32, len(w)))
                size += len(w)
                if size >= shard_words:
                    held.append(b.slice(first, i + 1 - first))
                    yield from close()
                    held, docs, size, first = [], [], 0, i + 1
            if first < b.num_rows:
                held.append(b.slice(first))
        if docs:
            yield from close()

    return run


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated per row of
    ``docs`` (doc_id, text)."""
    m = mark(docs, benchmark, ["doc_id"], window=window)
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    ids = F.array_join(F.array_sort("hit_items"), ",")
    return m.select("doc_id", "n_words", hit.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
                    F.sha2(ids.cast("binary"), 256).alias("items_sha256"),
                    (hit > 0).alias("contaminated"))


_BYTES_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def cut_spans(text: str, spans: list[dict]) -> str:
    """``text`` without the words of ``spans``; what stays on either side
    stays as it is, a cut between words leaves a line break."""
    raw = text.encode("utf-8", "surrogatepass")
    ends = [(m.start(), m.end()) for m in _BYTES_WORD.finditer(raw)]
    out, at = [], 0
    for s in spans:
        out.append(raw[at:ends[s["start"]][0]])
        at = ends[s["end"] - 1][1]
    out.append(raw[at:])
    return b"\n".join(out).decode("utf-8", "surrogatepass")


def cut(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the removal spans cut out of ``text`` (and ``n_chars``
    following it, where there is one); a document of which no word is left
    goes, one without an occurrence keeps its row as it is."""
    rest = [c for c in docs.columns if c != "text"]
    inner = {c: f"_c{i}" for i, c in enumerate(rest)}       # no clash with the added columns
    rows = docs.select(F.col("text").alias("text"), *[F.col(f"`{c}`").alias(n) for c, n in inner.items()])
    schema = T.StructType([rows.schema[n] for n in inner.values()]
                          + [T.StructField("_kept_text", T.StringType()), T.StructField("_cut", T.BooleanType())])

    def without(b: pa.RecordBatch, n_words: list, spans: list, items: list) -> pa.RecordBatch:
        texts, keep, changed = [], [], []
        for i, (t, s, n) in enumerate(zip(b.column("_doc_text").to_pylist(), spans, n_words)):
            if s and sum(x["end"] - x["start"] for x in s) == n:
                continue
            keep.append(i)
            texts.append(cut_spans(t, s) if s else t)
            changed.append(bool(s))
        left = b.take(pa.array(keep, pa.int64()))
        return pa.RecordBatch.from_arrays(
            [left.column(n) for n in inner.values()] + [pa.array(texts, pa.string()), pa.array(changed, pa.bool_())],
            [*inner.values(), "_kept_text", "_cut"])

    # cut where the spans are found: one worker a task, the texts go there once
    clean = mark(rows, benchmark, list(inner.values()), window=window, leave=(without, schema))
    out = []
    for c in docs.columns:
        if c == "text":
            out.append(F.col("_kept_text").alias("text"))
        elif c == "n_chars":
            kept = F.col(inner[c])
            out.append(F.when(F.col("_cut"), F.length("_kept_text").cast(docs.schema[c].dataType))
                       .otherwise(kept).alias(c))
        else:
            out.append(F.col(inner[c]).alias(c))
    return clean.select(out)
