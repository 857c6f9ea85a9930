"""Exact top-k inner products by the threshold algorithm.

Every block of vectors keeps one list per dimension, sorted by that
component.  A query walks the lists from the end that its own component's sign
favours; the components at the current depth bound the score of every vector
not yet seen, and the walk stops when the bound cannot beat the k-th best
score.  A task carries each query's k-th best score from block to block, so
later walks stop against it; the answers of all tasks are merged per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import batch_of, map_arrow, saved

SCALE = 1024
BLOCK_VECTORS = 16_384
QUERY_BLOCK = 2_048
FIRST_DEPTH = 64
SAFE = 2.0 ** 62        # sums of absolute products below it fit 64 bits


class SortedLists:
    """A block's vectors (ids, integer matrix) with its per-dimension lists."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], np.ascontiguousarray(x[order])
        self.lists = np.argsort(self.x, axis=0, kind="stable").astype(np.int32)   # ascending
        self.peak = np.abs(self.x.astype(np.float64)).max(axis=0, initial=0.0)

    def top(self, query_id: int, q: np.ndarray, k: int, floor: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best, ties to the smaller id; those below
        ``floor`` may be left out.  Products that could pass 64 bits are
        computed with Python's integers; a best score that does raises."""
        if np.abs(q.astype(np.float64)) @ self.peak < SAFE:
            return self._walk(query_id, q, self.x, k, floor)
        ids, scores = self._walk(query_id, q.astype(object), self.x.astype(object), k, floor)
        if len(scores) and not -2**63 <= min(scores) <= max(scores) < 2**63:
            raise OverflowError(f"an inner product of query {query_id} does not fit 64 bits")
        return ids, scores.astype(np.int64)

    def _walk(self, query_id: int, q: np.ndarray, x: np.ndarray, k: int,
              floor: int | None) -> tuple[np.ndarray, np.ndarray]:
        n, dims = len(self.ids), np.flatnonzero(q)
        seen = np.zeros(n, dtype=bool)
        best = np.empty(0, dtype=np.int64)
        scores = np.empty(0, dtype=q.dtype)
        if not len(dims):                       # every score is 0
            best = np.flatnonzero(self.ids != query_id)[:k]
            return self.ids[best], np.zeros(len(best), dtype=np.int64)
        down = q[dims] > 0
        start, depth = 0, FIRST_DEPTH
        while start < n:
            stop = min(n, start + depth)
            steps = np.arange(start, stop)
            rows = np.where(down, n - 1 - steps[:, None], steps[:, None])
            found = np.unique(self.lists[rows, dims])
            found = found[~seen[found]]
            seen[found] = True
            found = found[self.ids[found] != query_id]
            if len(found):
                best = np.concatenate([best, found])
                scores = np.concatenate([scores, x[found] @ q])
                keep = np.argsort(self.ids[best], kind="stable")
                keep = keep[np.argsort(-scores[keep], kind="stable")][:k]
                best, scores = best[keep], scores[keep]
            edge = np.where(down, n - stop, stop - 1)
            bound = int((q[dims] * x[self.lists[edge, dims], dims]).sum())
            # an equal one could have a smaller id
            if len(best) == k and scores[-1] > bound or floor is not None and floor > bound:
                break
            start, depth = stop, depth * 4
        return self.ids[best], scores


def usable_vectors(table: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """(vec_id, v array<long>): floor(scale * x) per component, x as double;
    vectors that are NULL, empty of ids, or hold NULL or non-finite components
    are left out; a component whose scaled floor passes 64 bits raises."""
    e = F.transform(F.col(embedding), lambda x: x.cast("double"))
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), e.alias("e"))
    fine = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x)
                    & (F.abs(x) != F.lit(float("inf"))))
    wide = F.lit("a scaled component does not fit 64 bits")
    return rows.filter(F.col("vec_id").isNotNull() & F.col("e").isNotNull() & fine) \
        .select("vec_id", F.transform("e", lambda x: F.when(F.abs(x * scale) < 2.0 ** 63, F.floor(x * scale).cast("long"))
                                      .otherwise(F.raise_error(wide).cast("long"))).alias("v"))


def top_k(table: DataFrame, k: int = 10, every: int = 100, vec_id: str = "vec_id",
          embedding: str = "embedding", scale: int = SCALE,
          block_vectors: int = BLOCK_VECTORS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row whose id is
    divisible by ``every``, the ``k`` rows of other ids with the highest
    integer inner products, ties to the smaller id; all, if there are fewer.

    Queries go out in blocks of about ``query_block`` (a bounded broadcast),
    one pass over the vectors each.  Vectors of different lengths are compared
    over the dimensions both have.  Rows of a repeated id are candidates each
    (equal ones share a score and take a rank each); as a query the repeated
    id's largest vector counts once.  Empty input gives no rows.
    """
    spark = table.sparkSession
    vectors = saved(usable_vectors(table, vec_id, embedding, scale), "vectors")
    queries = vectors.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.max("v").alias("v"))
    blocks = max(1, -(-queries.count() // query_block))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    out = None
    for i in range(blocks):
        mine = queries if blocks == 1 else \
            queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == i)
        shipped = spark.sparkContext.broadcast({r.vec_id: np.array(r.v, dtype=np.int64) for r in mine.collect()})
        part = _search(vectors, shipped, k, block_vectors) \
            .withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k) \
            .select("query_id", "rank", "vec_id", "score")
        if blocks > 1:                      # this block's answers are kept, its queries let go
            part = saved(part, "top-k")
            shipped.unpersist()
        out = part if out is None else out.unionByName(part)
    return out


def _search(vectors: DataFrame, shipped, k: int, block_vectors: int) -> DataFrame:
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def search(block: list[pa.RecordBatch], tops: dict[int, np.ndarray]) -> pa.RecordBatch:
        t = pa.Table.from_batches(block)
        vec_ids = t.column("vec_id").to_numpy()
        lists = t.column("v").combine_chunks()
        lengths = np.diff(lists.offsets.to_numpy())
        width = int(lengths.max(initial=0))
        x = np.zeros((len(vec_ids), width), dtype=np.int64)
        x[np.arange(width) < lengths[:, None]] = lists.flatten().to_numpy()
        index = SortedLists(vec_ids, x)
        found = []
        for qid, q in shipped.value.items():
            q = np.pad(q[:width], (0, max(0, width - len(q))))
            so_far = tops.get(qid, np.empty(0, dtype=np.int64))
            ids, scores = index.top(qid, q, k, int(so_far[0]) if len(so_far) == k else None)
            found.append((qid, ids, scores))
            tops[qid] = np.sort(np.concatenate([so_far, scores]))[-k:]
        return batch_of(schema,
                        query_id=np.concatenate([np.full(len(a), q) for q, a, _ in found]),
                        vec_id=np.concatenate([a for _, a, _ in found]),
                        score=np.concatenate([s for _, _, s in found]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, n, tops = [], 0, {}
        for b in batches:
            for at in range(0, b.num_rows, block_vectors):
                block.append(b.slice(at, block_vectors))
                n += block[-1].num_rows
                if n >= block_vectors:
                    if shipped.value:
                        yield search(block, tops)
                    block, n = [], 0
        if n and shipped.value:
            yield search(block, tops)

    return map_arrow(vectors, run, "query_id long, vec_id long, score long")
