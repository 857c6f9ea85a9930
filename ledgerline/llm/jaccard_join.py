"""Exact n-gram Jaccard join in the metric space of shingle sets.

Jaccard distance is a metric: pivots cut the space into Voronoi regions, and
with a link radius eps = 1 - threshold the triangle inequality says which
sets near a boundary must also be copied into the neighbouring region.

1.  Sets that share nothing are at distance 1 from one another, so no set can
    serve as their pivot.  The first pivots are therefore taken in parts of
    the space: sets are grouped with those of the sizes that they can link
    with, and the shingles of a group are cut by their hash into more parts
    than linked sets can differ in shingles (at most (1 - t) / (1 + t) of both
    sizes).  A linked pair then has distance 0 in some part: the content of a
    part is the pivot of the region of all sets that hold it there, and a set
    is copied to the regions of all its parts.
2.  There are more parts than needed, so a linked pair meets in several
    regions: in so many more than the pair has parts that are empty or in a
    large region.  Pairs that meet in small regions are counted, and only those
    that meet often enough are joined (``candidate_links``).  Sets most of whose
    parts are common ones (lines that many texts repeat) are cut once more among
    themselves, and at last joined by any region that they share.  What is
    joined makes clusters; no link leaves a cluster.
3.  A cluster too large for one task keeps together only sets that share one
    of their rarest shingles, which linked sets do (``rare_shingle_regions``).
    What is still too large is cut by pivot sets: every member goes to its
    nearest pivot p and to every pivot q with d(x, q) <= d(x, p) + 2 eps.
    Members within eps of their pivot are linked to it; one that no unlinked
    member can reach within eps is settled and leaves.  This recurs until the
    regions are small; a region that pivots do not divide is joined in pairs
    of bounded blocks of sets of like size.
4.  A cluster that fits one task is cut in the same way there, by pivot sets,
    windows and settled members, down to regions whose members are all pivots.
    Only a region that neither its pivots nor settled members shrink is joined
    by exact distances to what the inverted lists of its rare shingles hold.

Equal sets are one class from the start.  The result is exact up to
collisions of 64-bit shingle hashes.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import batch_of, free_finished_shuffles, give_back_driver_memory, map_arrow, saved, texts_of
from ledgerline.llm.components import components

CACHE_WORDS = 150_000
PIVOT_BLOCK = 1_000_000            # pivots of a task's input that are linked at a time
SMALL_REGION = 16                  # sets of a region of which every pair is counted
MET_ROWS = 1 << 18                 # rows of regions that are paired at a time, about
CROWDED_ROUNDS = 3                 # rounds that count the pairs of the sets left
LOCAL_SHINGLES = 2_000_000         # shingles of a region that one task joins
PIVOTS = 8                         # pivot sets per region and round
WAVES = 4                          # passes in which an undivided region's pairs of blocks are joined
SHRUNK = 0.7                       # a round must leave at most this share of a region in one place
RARE_ROUNDS = 2                    # rounds that part large regions by rare shingles
COUNTED_SETS = 20_000              # sets of large regions whose shingles are counted, about
SLOT_BITS, CHUNK = 23, 4096        # counters (as a power of two), and how many travel in a row
FILTER_BITS = 23                   # bits (as a power of two) of the members' filter
TINY = 1e-9

_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                  0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3],
                 dtype=np.uint64)


class _WordHashes(dict):
    def __missing__(self, word):
        v = self[word] = xxhash.xxh3_64_intdigest(word)
        return v


class Shingler:
    """Sorted distinct 64-bit hashes of a text's shingles: ``size`` words
    each, the whole sequence if there are fewer, none without words.  Words
    are split at ASCII white space, A-Z is lower-cased."""

    def __init__(self, size: int):
        if not 1 <= size <= len(_MULT):
            raise ValueError(f"shingles of 1 to {len(_MULT)} words")
        self.size, self.words = size, _WordHashes()

    def __call__(self, text: str) -> np.ndarray:
        w = text.encode("utf-8", "surrogatepass").lower().split()
        if not w:
            return np.empty(0, np.uint64)
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        h = np.fromiter(map(self.words.__getitem__, w), np.uint64, len(w))
        k = min(self.size, len(h))
        n = len(h) - k + 1
        x = np.full(n, k, np.uint64)
        for j in range(k):
            x += h[j:j + n] * _MULT[j]
        x ^= x >> np.uint64(31)
        x *= np.uint64(0x7FB5D329728EA185)
        x ^= x >> np.uint64(27)
        return np.unique(x)


# --- sets and their pivots ----------------------------------------------------

class Parts:
    """Pivots of a set (sorted hashes): one per part and size group.

    Size group g holds the sets of size bands g - 1 and g; a linked pair whose
    smaller set is in band g - 1 meets there.  With ``spare`` parts more than
    needed, a linked pair can agree in empty parts alone only if both sets
    have more than ``spare`` of them: only such sets have pivots for those."""

    def __init__(self, percent: int):
        self.percent, self.bands = percent, [1]

    def layout(self, group: int) -> tuple[int, int]:
        """(parts, spare) of a size group."""
        small = self.bands[group] - 1
        both = small + 100 * small // self.percent
        differ = (100 - self.percent) * both // (100 + self.percent)
        spare = 1 + differ // 8 if differ else 0
        return differ + 1 + spare, spare

    def band(self, n: int) -> int:
        """The size band of a set of ``n`` shingles."""
        while self.bands[-1] <= n:
            self.bands.append(100 * self.bands[-1] // self.percent + 1)
        return bisect.bisect_right(self.bands, n) - 1

    def _cuts(self, s: np.ndarray) -> Iterator[tuple[int, bool, int, int, np.ndarray, np.ndarray]]:
        """(group, whether it is the set's lower one, its parts, its spare, part
        of each shingle, where a part begins) of the size groups of a set."""
        band = self.band(len(s))
        for g in (band, band + 1):
            if g:
                parts, spare = self.layout(g)
                own = ((s >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)      # ascends with s
                yield g, g == band, parts, spare, own, np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))

    def room(self, s: np.ndarray) -> list[int]:
        """In the groups where the set is of the smaller and of the larger
        sizes, the spare parts that its empty parts leave."""
        out = [0, 0]
        if len(s):
            for _, larger, parts, spare, _, at in self._cuts(s):
                out[larger] = spare - (parts - len(at))
        return out

    def regions(self, s: np.ndarray) -> Iterator[tuple[bool, np.ndarray]]:
        """(whether the set is of the larger sizes of the group, the pivots of
        its parts that are not empty) of each size group."""
        mixed = _mix(s)
        for g, larger, _, _, own, at in self._cuts(s):
            yield larger, _mix(np.add.reduceat(mixed, at) + own[at] * _MULT[0] + np.uint64(g << 40))

    def __call__(self, s: np.ndarray) -> np.ndarray:
        if not len(s):
            return s
        mixed = _mix(s)
        out = []
        for g, _, parts, spare, own, at in self._cuts(s):
            place, content = own[at], np.add.reduceat(mixed, at)
            if parts - len(at) > spare:
                none = np.setdiff1d(np.arange(parts, dtype=np.uint64), place)
                place, content = np.concatenate([place, none]), np.concatenate([content, np.zeros(len(none), np.uint64)])
            out.append(_mix(content + place * _MULT[0] + np.uint64(g << 40)))
        return np.concatenate(out)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(27))


def _digest(s: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(s.tobytes())
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def signatures(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, n (shingles), d1, d2 (128-bit digest of the set), small, large
    (``Parts.room``)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()),
                        ("small", pa.int64()), ("large", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, parts = Shingler(size), Parts(percent)
        for b in batches:
            rows = []
            for t in texts_of(b):
                s = shingles(t)
                rows.append((len(s), *_digest(s), *parts.room(s)))
            cols = zip(*rows) if rows else [()] * 5
            yield batch_of(schema, doc_id=b.column("doc_id"), **dict(zip(schema.names[1:], cols)))

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run,
                     "doc_id long, n long, d1 long, d2 long, small long, large long")


_PIVOT_ROWS = pa.schema([("pivot", pa.int64()), ("node", pa.int64())])


def _block_stars(sets: Iterator[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Rows (pivot, node) of the (node, its pivots) of a task.

    A block links its own nodes of one pivot to the least of them and sends on
    only that one, so a very common pivot costs a row per block.  A link found
    in a block travels as a pivot of its own."""
    def close(pivots: list, nodes: list) -> pa.RecordBatch:
        p, n = np.concatenate(pivots).view(np.int64), np.repeat(np.array(nodes, np.int64), [len(x) for x in pivots])
        order = np.lexsort((n, p))
        p, n = p[order], n[order]
        first = np.concatenate([[True], p[1:] != p[:-1]])
        home = n[first][np.cumsum(first) - 1]
        link = np.unique(np.stack([n, home])[:, n != home], axis=1)
        own = (link.view(np.uint64) * _MULT[:2, None]).sum(axis=0, dtype=np.uint64).view(np.int64)
        return batch_of(_PIVOT_ROWS, pivot=np.concatenate([p[first], own, own]),
                        node=np.concatenate([n[first], link[0], link[1]]))

    pivots, nodes, held = [], [], 0
    for node, own in sets:
        pivots.append(own)
        nodes.append(node)
        held += len(own)
        if held >= PIVOT_BLOCK:
            yield close(pivots, nodes)
            pivots, nodes, held = [], [], 0
    if held:
        yield close(pivots, nodes)


def _stars(rows: DataFrame) -> DataFrame:
    """Links (a, b) of the nodes of each pivot to the least of them."""
    home = Window.partitionBy("pivot").orderBy("node")
    return rows.withColumn("home", F.first("node").over(home)).filter("home <> node") \
        .select(F.col("node").alias("a"), F.col("home").alias("b"))


def _region_rows(sets: Iterator[tuple[int, list[tuple[bool, np.ndarray]]]], small: int) -> Iterator[pa.RecordBatch]:
    """Rows (pivot, entry) of the (digest, its ``Parts.regions``) of a task.

    An entry is a set in one of its size groups: the digest with 1 as its
    lowest bit in the group where it is of the larger sizes, else 0.  Pivots
    are even.  A block sends ``small`` + 1 entries of a pivot at most, which
    tell that its region is large; the others travel under odd keys of their own."""
    def close(pivots: list, nodes: list) -> pa.RecordBatch:
        p = np.concatenate(pivots) & ~np.uint64(1)
        n = np.repeat(np.array(nodes, np.int64), [len(x) for x in pivots])
        order = np.argsort(p, kind="stable")
        p, n = p[order], n[order]
        at = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
        many = np.arange(len(p)) - np.repeat(at, np.diff(np.append(at, len(p)))) > small
        p[many] = _mix(p[many] * _MULT[0] + n[many].view(np.uint64) * _MULT[1]) | np.uint64(1)
        return batch_of(_PIVOT_ROWS, pivot=p.view(np.int64), node=n)

    pivots, nodes, seen, held = [], [], set(), 0
    for node, regions in sets:
        if node in seen:
            continue
        seen.add(node)
        for larger, own in regions:
            pivots.append(own)
            nodes.append((node & -2) + larger)
            held += len(own)
        if held >= PIVOT_BLOCK:
            yield close(pivots, nodes)
            pivots, nodes, seen, held = [], [], set(), 0
    if held:
        yield close(pivots, nodes)


_MET = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _met(rows: DataFrame, small: int) -> DataFrame:
    """(a, b, times) of ``_region_rows``: how often two entries, not both of
    the larger sizes, meet in regions of at most ``small`` entries; with a NULL
    b, in how many larger regions the entry a is."""
    def close(p: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        new = np.concatenate([[True], (p[1:] != p[:-1]) | (n[1:] != n[:-1])])
        p, n = p[new], n[new]
        at = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
        size = np.diff(np.append(at, len(p)))
        size[(p[at] & 1) == 1] = small + 1
        a, b = [], []
        for k in np.unique(size[(size > 1) & (size <= small)]):
            first = at[size == k]
            for i in range(k):
                for j in range(i + 1, k):
                    x, y = n[first + i], n[first + j]
                    pair = (x & y & 1) == 0
                    a.append(x[pair])
                    b.append(y[pair])
        alone = n[np.repeat(size > small, np.diff(np.append(at, len(p))))]
        a, b = np.concatenate([*a, alone]), np.concatenate([*b, alone])
        return batch_of(_MET, a=a, b=pa.array(b, mask=np.arange(len(b)) >= len(b) - len(alone)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, enough = [], 0, MET_ROWS
        for b in batches:
            held.append((b.column("pivot").to_numpy(), b.column("node").to_numpy()))
            count += b.num_rows
            if count < enough:
                continue
            p, n = (np.concatenate(x) for x in zip(*held))
            last = int(np.searchsorted(p, p[-1]))           # the last region may go on
            if last:
                yield close(p[:last], n[:last])
            held, count = [(p[last:], n[last:])], len(p) - last
            enough = MET_ROWS + 2 * count
        if count:
            yield close(*(np.concatenate(x) for x in zip(*held)))

    met = rows.withColumn("here", F.count(F.lit(1)).over(Window.partitionBy("pivot"))) \
        .filter("here > 1 OR pivot % 2 <> 0").select("pivot", "node").sortWithinPartitions("pivot", "node")
    return map_arrow(met, run, "a long, b long") \
        .groupBy("a", "b").agg(F.count(F.lit(1)).alias("times"))


def candidate_links(docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs (a, b) of sets (by their digest d1 with 0 as its lowest bit) that
    join all linked sets of ``classes`` (d1, rep, small, large), and few others.

    Linked sets agree in more parts of the group where the smaller one is of
    the smaller sizes than are spare there.  Parts in which they agree are
    empty in both or one region of both; so they meet in more small regions
    than remain of the spare parts (``room``) without the empty parts and large
    regions of either.  If for both nothing remains, both are crowded: they are
    looked at again without the others, by whom regions were large, and in the
    end joined by any pivot that they share."""
    small = SMALL_REGION

    def of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, parts = Shingler(size), Parts(percent)
        sets = (s for b in batches for s in map(shingles, texts_of(b)) if len(s))
        yield from _region_rows(((_digest(s)[0], parts.regions(s)) for s in sets), small)

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        return (np.frombuffer(x, np.uint64) for b in batches for x in b.column("shingles").to_pylist())

    def of_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = Parts(percent)
        yield from _region_rows(((_digest(s)[0], parts.regions(s)) for s in sets_of(batches)), small)

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = Parts(percent)
        yield from _block_stars((_digest(s)[0] & -2, parts(s)) for s in sets_of(batches))

    digest = F.expr("d1 & -2L").alias("digest")
    entries = classes.select(digest, F.inline(F.array(F.struct(F.expr("d1 & -2L").alias("entry"), F.col("small").alias("room")),
                                                      F.struct(F.expr("d1 | 1L").alias("entry"), F.col("large").alias("room")))))
    rows = map_arrow(docs.filter("doc_id IS NOT NULL").select("text"), of_texts, "pivot long, node long")
    out, sets, before = [], None, None
    for level in range(CROWDED_ROUNDS):
        met = saved(_met(rows, small), f"met-{level}")
        free_finished_shuffles(docs.sparkSession)           # those of the pivots
        taken = met.filter("b IS NULL").select(F.col("a").alias("entry"), F.col("times").alias("taken"))
        room = saved(entries.join(taken, "entry", "left")
                     .select("digest", "entry", (F.col("room") - F.coalesce("taken", F.lit(0))).alias("room")), f"room-{level}")
        pairs = met.filter("b IS NOT NULL")
        for end in ("a", "b"):
            pairs = pairs.join(room.select(F.col("entry").alias(end), F.col("room").alias(f"room_{end}")), end)
        out.append(pairs.filter("times > greatest(room_a, room_b)")
                   .select(F.expr("a & -2L").alias("a"), F.expr("b & -2L").alias("b")))
        crowded = saved(room.filter("room < 0").select("digest").distinct(), f"crowded-{level}")
        count = crowded.count()
        if not count:
            break
        if sets is None:
            nodes = classes.select(digest, F.col("rep").alias("node")).join(crowded, "digest")
            sets = saved(member_sets(docs, saved(nodes, "crowded-nodes"), size), "crowded-sets")
        else:
            sets = sets.join(crowded, "digest", "left_semi")
        rows = sets.select("shingles")
        if level + 1 == CROWDED_ROUNDS or before and count > SHRUNK * before:
            out.append(_stars(map_arrow(rows, stars, "pivot long, node long")))
            break
        entries, before = entries.join(crowded, "digest", "left_semi"), count
        rows = map_arrow(rows, of_sets, "pivot long, node long")
    links = out[0]
    for x in out[1:]:
        links = links.unionByName(x)
    return links


def _keyed_sets(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """(node, its shingles mixed with the region) of rows (region, node,
    shingles)."""
    for r, n, s in zip(*(batch.column(c).to_pylist() for c in ("region", "node", "shingles"))):
        yield n, _mix(np.frombuffer(s, np.uint64) ^ np.uint64(xxhash.xxh3_64_intdigest(r)))


def _shingle_counts(members: DataFrame) -> np.ndarray:
    """How often the shingles of each slot of their hash occur in about
    ``COUNTED_SETS`` of the sets, up to 255; it only says in which order
    shingles are looked at."""
    every = F.lit(-(-members.count() // COUNTED_SETS) or 1)
    schema = pa.schema([("chunk", pa.int32()), ("counts", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << SLOT_BITS, np.uint32)      # of a task
        for b in batches:
            for _, keys in _keyed_sets(b):
                np.add.at(seen, keys >> np.uint64(64 - SLOT_BITS), np.uint32(1))
        chunks = np.minimum(seen, 255).astype(np.uint8).reshape(-1, CHUNK)
        own = np.flatnonzero(chunks.any(axis=1))
        yield batch_of(schema, chunk=own.astype(np.int32), counts=[chunks[i].tobytes() for i in own])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, c in zip(b.column("chunk").to_pylist(), b.column("counts").to_pylist()):
                sums[k] = np.minimum(sums.get(k, 0) + np.frombuffer(c, np.uint8).astype(np.uint16), 255)
        yield batch_of(schema, chunk=list(sums), counts=[c.astype(np.uint8).tobytes() for c in sums.values()])

    rows = members.filter(F.pmod(F.xxhash64("node", F.lit(7)), every) == 0).select("region", "node", "shingles")
    out = np.zeros(1 << SLOT_BITS, np.uint8).reshape(-1, CHUNK)
    for r in map_arrow(map_arrow(rows, count, "chunk int, counts binary").repartition("chunk"), add,
                       "chunk int, counts binary").collect():
        out[r.chunk] = np.frombuffer(r.counts, np.uint8)
    return out.reshape(-1)


def rare_shingle_regions(members: DataFrame, percent: int) -> DataFrame:
    """``members`` (region, node, shingles) in smaller regions that no link
    leaves, without those that can link with nothing.

    In any order of all shingles linked sets share one of their first
    n - ceil(threshold * n) + 1: these are the set's pivots here, in each of
    its size groups (see ``Parts``).  In the order rare before frequent few
    sets share one that have no link."""
    shipped = members.sparkSession.sparkContext.broadcast(_shingle_counts(members))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sizes = shipped.value, Parts(percent)

        def first(keys: np.ndarray) -> np.ndarray:
            order = np.lexsort((keys, counts[keys >> np.uint64(64 - SLOT_BITS)]))
            own = keys[order[:len(keys) + percent * len(keys) // -100 + 1]]
            band = sizes.band(len(keys))
            return np.concatenate([_mix(own + np.uint64(g << 40)) for g in (band, band + 1)])

        yield from _block_stars((n, first(keys)) for b in batches for n, keys in _keyed_sets(b))

    found = components(_stars(map_arrow(members.select("region", "node", "shingles"), run, "pivot long, node long")))
    return members.join(found, "node").select(F.col("component").cast("string").alias("region"), "node", "shingles")


def member_sets(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """(node, d1, shingles binary) of the documents in ``nodes`` (node).  A
    bounded filter of their ids thins the texts before they are cut into
    shingles; the join that follows is exact."""
    at = F.pmod(F.xxhash64(F.col("node")), F.lit(1 << FILTER_BITS))
    words = nodes.select(at.alias("at")).select(F.expr("at div 64").alias("w"), F.expr("CAST(at % 64 AS INT)").alias("p")) \
        .groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, p)")).alias("bits")).collect()
    bits = np.zeros((1 << FILTER_BITS) // 64, np.uint64)
    for r in words:
        bits[r.w] = np.uint64(r.bits & (1 << 64) - 1)
    shipped = docs.sparkSession.sparkContext.broadcast(bits)
    schema = pa.schema([("node", pa.int64()), ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, held = Shingler(size), shipped.value
        for b in batches:
            p = b.column("p").to_numpy(zero_copy_only=False)
            keep = np.flatnonzero((held[p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1))
            if len(keep):
                t = b.take(pa.array(keep))
                yield batch_of(schema, node=t.column("doc_id"),
                               shingles=[shingles(x).tobytes() for x in texts_of(t)])

    rows = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("node"), "text") \
        .select(F.col("node").alias("doc_id"), "text", at.alias("p"))
    return map_arrow(rows, run, "node long, shingles binary").join(nodes, "node")


# --- joins of regions ---------------------------------------------------------

def _codes(sets: list[np.ndarray]) -> tuple[np.ndarray, int]:
    """The sets' shingles end to end as dense codes in the order of their
    hashes, and the number of codes; in less memory than ``np.unique``."""
    flat = np.concatenate(sets)
    order = np.argsort(flat)
    flat = flat[order]
    new = np.empty(len(flat), dtype=bool)
    new[:1] = False
    np.not_equal(flat[1:], flat[:-1], out=new[1:])
    del flat
    code = np.empty(len(order), dtype=np.int32)
    code[order] = np.cumsum(new, dtype=np.int32)
    return code, int(new.sum()) + 1 if len(code) else 0


def link_region(sets: list[np.ndarray], percent: int, known: np.ndarray | None = None) -> np.ndarray:
    """Component (smallest place) of each set under links, exactly: in the
    order rare before frequent, linked sets share one of their first
    n - ceil(threshold * n) + 1 shingles, so the inverted lists of those hold
    all partners; the distances to them are exact.  ``known``: components that
    links found earlier make; a pair within one needs no distance, so the
    members of the largest look for nothing and are only found."""
    m = len(sets)
    label = np.arange(m) if known is None else known.copy()
    lens = np.array([len(s) for s in sets], dtype=np.int64)
    at = np.concatenate([[0], np.cumsum(lens)])
    flat, codes = _codes(sets)
    count = np.bincount(flat, minlength=codes)
    rank = np.empty(len(count), dtype=np.int32)
    rank[np.argsort(count, kind="stable")] = np.arange(len(count), dtype=np.int32)
    flat = rank[flat]
    first = []
    for i in range(m):
        own = np.sort(flat[at[i]:at[i + 1]])
        flat[at[i]:at[i + 1]] = own
        first.append(own[:len(own) + percent * len(own) // -100 + 1])
    shingle, owner = np.concatenate(first), np.repeat(np.arange(m), [len(f) for f in first])
    order = np.argsort(shingle, kind="stable")
    owner, ends = owner[order], np.cumsum(np.bincount(shingle, minlength=len(count)))
    starts = np.concatenate([[0], ends[:-1]])
    mark = np.zeros(len(count), dtype=bool)
    asks = label != np.bincount(label).argmax()
    for i in np.flatnonzero(asks):
        lists = [owner[starts[t]:ends[t]] for t in first[i] if ends[t] - starts[t] > 1]
        if not lists:
            continue
        near = np.unique(np.concatenate(lists))
        near = near[((near < i) | ~asks[near]) & (label[near] != label[i])]
        near = near[100 * np.minimum(lens[near], lens[i]) >= percent * np.maximum(lens[near], lens[i])]
        if not len(near):
            continue
        mark[flat[at[i]:at[i + 1]]] = True
        before = np.concatenate([[0], np.cumsum(lens[near])])
        if 4 * before[-1] > len(flat):
            common = np.add.reduceat(mark[flat], at[:-1], dtype=np.int64)[near]
        else:
            held = flat[np.arange(before[-1]) + np.repeat(at[near] - before[:-1], lens[near])]
            common = np.add.reduceat(mark[held], before[:-1], dtype=np.int64)
        mark[flat[at[i]:at[i + 1]]] = False
        linked = near[100 * common >= percent * (lens[near] + lens[i] - common)]
        for other in np.unique(label[linked]):
            low, high = sorted((other, label[i]))
            label[label == high] = low
    return label


class _Classes:
    """Disjoint classes of the places 0..n-1, named by their smallest place."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, places, other: int) -> None:
        for i in places:
            low, high = sorted((self.find(i), self.find(other)))
            self.up[high] = low


def voronoi_classes(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Component (smallest place) of each set under links, exactly, by Voronoi
    cuts in memory.

    A round takes up to ``PIVOTS`` pivots, in turn the next member of a fixed
    random order and the member farthest from the pivots so far, and links
    what lies within eps of one.  A linked pair meets in the region of the
    pivot nearest to either, since both lie in its window of 2 eps.  In a
    region of pivot p, a member linked to p is settled if every member not
    linked to p is farther than eps from it by the triangle inequality: what
    it still links with there is linked to p as well.  The others recur region
    by region, or in one region if regions overlap too much."""
    m, eps = len(sets), 1 - percent / 100
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    flat, codes = _codes(sets)
    mark = np.zeros(codes, dtype=bool)
    order = np.random.default_rng(m).permutation(m)
    turn = np.empty(m, dtype=np.int64)
    turn[order] = np.arange(m)
    classes = _Classes(m)
    todo = [np.arange(m)]
    while todo:
        own = todo.pop()
        if len({classes.find(i) for i in own.tolist()}) < 2:
            continue
        lens = at[own + 1] - at[own]
        here = np.concatenate([flat[at[i]:at[i + 1]] for i in own])
        starts = np.concatenate([[0], np.cumsum(lens)[:-1]])
        near, used = np.full(len(own), np.inf), np.zeros(len(own), dtype=bool)
        dist, link = [], []
        while len(dist) < PIVOTS and not used.all():
            k = int(np.argmin(np.where(used, m, turn[own])) if len(dist) % 2 == 0 else np.argmax(np.where(used, -1, near)))
            used[k] = True
            pivot = here[starts[k]:starts[k] + lens[k]]
            mark[pivot] = True
            common = np.add.reduceat(mark[here], starts, dtype=np.int64)
            mark[pivot] = False
            union = lens + lens[k] - common
            dist.append(1 - common / union)
            link.append(100 * common >= percent * union)
            near = np.minimum(near, dist[-1])
            classes.join(own[link[-1]].tolist(), int(own[k]))
        if used.all():
            continue
        parts = []
        for d, linked in zip(dist, link):
            cell = d <= near + 2 * eps + TINY
            apart = cell & ~linked
            if apart.any():
                parts.append(cell & (~linked | (d >= d[apart].min() - eps - TINY)))
        rest = np.logical_or.reduce(parts) if parts else np.zeros(len(own), dtype=bool)
        if max((p.sum() for p in parts), default=0) <= SHRUNK * len(own) and sum(p.sum() for p in parts) <= 2 * len(own):
            todo += [own[p] for p in parts]
        elif rest.sum() <= SHRUNK * len(own):
            todo.append(own[rest])
        else:
            left = own[rest]
            _, first, known = np.unique([classes.find(i) for i in left.tolist()], return_index=True, return_inverse=True)
            for i, k in enumerate(link_region([flat[at[j]:at[j + 1]] for j in left], percent, first[known])):
                classes.join([int(left[i])], int(left[k]))
    return np.array([classes.find(i) for i in range(m)])


def _distances(sets: list[np.ndarray], pivot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(common shingles, union size) of each set with the pivot."""
    lens = np.array([len(s) for s in sets], dtype=np.int64)
    flat = np.concatenate(sets)
    where = np.minimum(np.searchsorted(pivot, flat), len(pivot) - 1)
    common = np.add.reduceat((pivot[where] == flat).astype(np.int64), np.concatenate([[0], np.cumsum(lens)[:-1]]))
    return common, lens + len(pivot) - common


def _local_links(regions: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of small regions (region, node, shingles): each member
    with the representative of its component there."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def close(nodes: list, sets: list) -> Iterator[pa.RecordBatch]:
        if len(nodes) > 1:
            label = voronoi_classes([np.frombuffer(s, np.uint64) for s in sets], percent)
            at = np.flatnonzero(label != np.arange(len(label)))
            if len(at):
                ids = np.array(nodes, dtype=np.int64)
                yield batch_of(schema, a=ids[at], b=ids[label[at]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        region, nodes, sets = None, [], []
        for b in batches:
            for r, n, s in zip(b.column("region").to_pylist(), b.column("node").to_pylist(),
                               b.column("shingles").to_pylist()):
                if r != region:
                    yield from close(nodes, sets)
                    region, nodes, sets = r, [], []
                nodes.append(n)
                sets.append(s)
        yield from close(nodes, sets)

    # By the region itself Spark may leave this shuffle out behind a join on it,
    # and then deal out a skewed partition of the join, small regions included.
    rows = regions.select("region", "node", "shingles").repartition(F.xxhash64("region")) \
        .sortWithinPartitions("region", "node")
    return map_arrow(rows, run, "a long, b long")


def _divide(regions: DataFrame, percent: int, level: int) -> DataFrame:
    """One round for large regions: (region, node, shingles, d, linked, hub)
    of every member in its own Voronoi region and in those whose window it
    lies in."""
    pick = Window.partitionBy("region").orderBy(F.xxhash64("node", F.lit(level)), "node")
    hubs = regions.select("region", "node").distinct().withColumn("i", F.row_number().over(pick)) \
        .filter(F.col("i") <= PIVOTS).select("region", "node")
    held = hubs.join(regions, ["region", "node"]).groupBy("region") \
        .agg(F.collect_list(F.struct("node", "shingles")).alias("hubs"))         # PIVOTS sets
    schema = pa.schema([("region", pa.string()), ("node", pa.int64()), ("shingles", pa.binary()),
                        ("d", pa.float64()), ("linked", pa.bool_()), ("hub", pa.int64())])
    window = 2 * (1 - percent / 100) + TINY

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            regs, hub_col = b.column("region").to_pylist(), b.column("hubs")
            sets = [np.frombuffer(s, np.uint64) for s in b.column("shingles").to_pylist()]
            nodes, raw = b.column("node").to_pylist(), b.column("shingles").to_pylist()
            out: dict[str, list] = {f.name: [] for f in schema}
            for r in sorted(set(regs)):
                own = [i for i, x in enumerate(regs) if x == r]
                pivots = sorted((h["node"], h["shingles"]) for h in hub_col[own[0]].as_py())
                mine = [sets[i] for i in own]
                both = [_distances(mine, np.frombuffer(s, np.uint64)) for _, s in pivots]
                d = np.stack([1 - c / u for c, u in both], axis=1)
                near = d.min(axis=1)
                for k, (hub, _) in enumerate(pivots):
                    c, u = both[k]
                    for j in np.flatnonzero(d[:, k] <= near + window):
                        i = own[j]
                        for name, v in (("region", f"{r}/{hub}"), ("node", nodes[i]), ("shingles", raw[i]),
                                        ("d", float(d[j, k])), ("linked", bool(100 * c[j] >= percent * u[j])),
                                        ("hub", hub)):
                            out[name].append(v)
            yield batch_of(schema, **out)

    return map_arrow(regions.select("region", "node", "shingles").join(held, "region"), run,
                     "region string, node long, shingles binary, d double, linked boolean, hub long")


def _in_block_pairs(regions: DataFrame, whole: DataFrame, percent: int) -> list[DataFrame]:
    """Regions that pivots do not divide, as pairs of blocks of about half a
    task's members each.  Blocks follow the sets' sizes, and linked sets have
    sizes within the threshold's ratio, so only blocks whose size ranges can
    link meet: a member is copied for its few neighbours, not for all.  The
    pairs come in ``WAVES`` frames, so that one pass holds a part of the copies."""
    n = F.expr("octet_length(shingles) div 8")
    rows = regions.join(whole, "region", "left_semi").withColumn("n", n) \
        .withColumn("part", F.pmod(F.xxhash64("node", F.lit(99)), F.lit(1024)))
    before = Window.partitionBy("region").orderBy("n", "part").rowsBetween(Window.unboundedPreceding, -1)
    cells = rows.groupBy("region", "n", "part").agg(F.sum("n").alias("load")) \
        .withColumn("block", F.floor(F.coalesce(F.sum("load").over(before), F.lit(0)) / (LOCAL_SHINGLES / 2)))
    cells = saved(cells.select("region", "n", "part", "block"), "block-cells")
    spans = cells.groupBy("region", "block").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    low = spans.select("region", F.col("block").alias("low"), F.col("most").alias("upto"))
    high = spans.select("region", F.col("block").alias("high"), F.col("least").alias("from"))
    pairs = low.join(high, "region").filter("low <= high").filter(100 * F.col("upto") >= percent * F.col("from")) \
        .withColumn("pair", F.concat_ws(":", "region", "low", "high")) \
        .select("region", "pair", F.explode(F.array_distinct(F.array("low", "high"))).alias("block"))
    pairs = saved(pairs, "block-pairs")

    def wave(i: int) -> DataFrame:
        mine = pairs.filter(F.pmod(F.xxhash64("pair"), F.lit(WAVES)) == i)
        meets = mine.groupBy("region", "block").agg(F.collect_list("pair").alias("pairs"))
        return rows.join(cells, ["region", "n", "part"]).join(meets, ["region", "block"]) \
            .select(F.explode("pairs").alias("region"), "node", "shingles")

    return [wave(i) for i in range(WAVES)]


def verified_links(members: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect every true component of ``members`` (region,
    node, shingles), and none besides true ones."""
    eps = 1 - percent / 100
    regions, links, level = members, [], 0
    while True:
        load = F.expr("sum(octet_length(shingles) div 8)")
        sizes = saved(regions.groupBy("region").agg(F.count(F.lit(1)).alias("size"), load.alias("load")), "region-sizes")
        fits = (F.col("load") <= LOCAL_SHINGLES) | (F.col("size") == 1)
        small = sizes.filter(fits & (F.col("size") > 1)).select("region")
        links.append(saved(_local_links(regions.join(small, "region", "left_semi"), percent), f"local-links-{level}"))
        give_back_driver_memory(members.sparkSession)       # and the shuffles of the regions' sets
        large = sizes.filter(~fits)
        if large.isEmpty():
            break
        rest = regions.join(large.select("region"), "region", "left_semi")
        if level < RARE_ROUNDS:
            regions = saved(rare_shingle_regions(rest, percent), "rare-regions")
            free_finished_shuffles(members.sparkSession)    # those of the pivots
            level += 1
            continue
        cells = _divide(rest, percent, level)
        narrow = saved(cells.select("region", "node", "d", "linked", "hub", F.octet_length("shingles").alias("bytes")),
                       f"cells-{level}")
        links.append(narrow.filter("linked AND node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")))
        edge = narrow.filter("NOT linked").groupBy("region").agg(F.min("d").alias("edge"))
        reach = F.col("d") >= F.col("edge") - F.lit(eps + TINY)
        stay = narrow.join(edge, "region").filter(~F.col("linked") | reach)
        # A region whose regions overlap too much stays one, without the members
        # settled in all of them; if those are few, it is joined in blocks.
        parent = F.regexp_extract("region", "^(.*)/[^/]*$", 1)
        stay = saved(stay.select(parent.alias("parent"), "region", "node"), f"unsettled-{level}")
        before = large.select(F.col("region").alias("parent"), F.col("size").alias("before"))

        def too_many(rows: DataFrame, *by: str) -> DataFrame:
            """Parents of which a group of rows keeps more than ``SHRUNK``."""
            return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("size")).join(before, "parent") \
                .filter(F.col("size") > SHRUNK * F.col("before")).select("parent").distinct()

        stuck = saved(too_many(stay, "parent", "region"), "stuck")
        left = saved(stay.join(stuck, "parent", "left_semi").select("parent", "node").distinct(), f"left-{level}")
        whole = saved(too_many(left, "parent").withColumnRenamed("parent", "region"), "whole")
        sets = rest.withColumnRenamed("region", "parent")
        once = sets.join(left, ["parent", "node"]).select(F.col("parent").alias("region"), "node", "shingles")
        for pairs in _in_block_pairs(once, whole, percent):
            links.append(saved(_local_links(pairs, percent), f"block-links-{level}"))
            free_finished_shuffles(members.sparkSession)    # those of the blocks
        cut = sets.join(stay.join(stuck, "parent", "left_anti"), ["parent", "node"]).select("region", "node", "shingles")
        regions = saved(cut.unionByName(once.join(whole, "region", "left_anti")), f"regions-kept-{level}")
        level += 1
    out = links[0]
    for x in links[1:]:
        out = out.unionByName(x)
    return out


def jaccard_components(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id per row of ``docs`` (doc_id, text):
    documents link when 100 * common >= percent * union of their shingle sets;
    component_id is the smallest doc_id reachable by links.

    Texts without words (NULL, empty, blank) have the empty set and link with
    nothing; rows with equal sets are linked; rows that repeat a doc_id are one
    document for linking; a NULL doc_id links with nothing and has a NULL
    component.  Empty input gives no rows.
    """
    give_back_driver_memory(docs.sparkSession)              # that of the work before
    sig = saved(signatures(docs, size, percent), "signatures")
    live = sig.filter("n > 0 AND doc_id IS NOT NULL")
    least = [F.min(c).alias(c) for c in ("small", "large")]         # equal in a class
    sets = saved(live.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), *least), "set-classes")
    classes = sets.select("d1", "d2", "rep")
    clusters = saved(components(candidate_links(docs, sets, size, percent)), "clusters")
    free_finished_shuffles(docs.sparkSession)               # those of the pivots
    members = classes.withColumn("node", F.expr("d1 & -2L")).join(clusters, "node") \
        .select(F.col("rep").alias("node"), "component")
    sets = member_sets(docs, saved(members, "cluster-members"), size)
    members = saved(sets.select(F.col("component").cast("string").alias("region"), "node", "shingles"), "cluster-sets")
    links = verified_links(members, percent)
    rows = sig.select("doc_id", "n", "d1", "d2").join(classes, ["d1", "d2"], "left")
    repeated = rows.filter("rep IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id") \
        .agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low <> high")
    same = rows.join(repeated, "doc_id").filter("rep <> low").select(F.col("rep").alias("a"), F.col("low").alias("b"))
    found = saved(components(links.unionByName(same)), "components")
    alone = F.when(F.col("n") > 0, F.col("rep")).otherwise(F.col("doc_id"))
    return rows.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left") \
        .select("doc_id", F.col("n").alias("n_shingles"),
                F.when(F.col("doc_id").isNotNull(), F.coalesce("component", alone)).alias("component_id"))


def keep_one_per_component(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """``docs`` with one row of each component: that of its smallest doc_id.

    Of rows that repeat a doc_id one stays, the least by the digest of its
    text; of NULL-id rows with words one of each text stays.  NULL-id rows
    without words, and all unlinked rows with an id of their own, stay.
    """
    found = jaccard_components(docs, size, percent)
    gone = found.filter("component_id <> doc_id").select("doc_id").distinct()
    repeated = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")) \
        .filter("rows > 1").select("doc_id")
    kept = docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    blank = F.coalesce("text", F.lit("")).rlike(r"^[\x20\x09-\x0D]*$")

    def one_of_each(rows: DataFrame, *by: str) -> DataFrame:
        """One row per ``by``; copies are merged before they shuffle."""
        row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
        least = F.struct(F.sha2(F.coalesce("text", F.lit("")), 256), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
        return rows.groupBy(*by).agg(F.min_by(row, least).alias("row")).select("row.*")

    own = kept.filter("doc_id IS NOT NULL")
    nameless = kept.filter(F.col("doc_id").isNull())
    out = own.join(repeated, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    for part in (one_of_each(own.join(repeated, "doc_id", "left_semi"), "doc_id"),
                 nameless.filter(blank), one_of_each(nameless.filter(~blank), "text")):
        out = out.unionByName(part.select(*[F.col(f"`{c}`") for c in docs.columns]))
    return out
