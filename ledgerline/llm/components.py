"""Connected components by alternating large-star and small-star rounds.

Every round is a written table in the shared folder; edges are never
gathered anywhere.  Minima are combined before they shuffle, so a node with
very many neighbours costs one row per task.

Edges run from the larger node a to the smaller node b, so the least of a
node's neighbourhood is its least b, or the node itself if it is no edge's a.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import give_back_driver_memory, saved


def _large_star(e: DataFrame) -> DataFrame:
    """Neighbours above a node go to the least of the node's neighbourhood."""
    low = e.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "b")
    return e.join(low, "b", "left").select("a", F.coalesce("m", "b").alias("b"))


def _small_star(e: DataFrame) -> DataFrame:
    """A node and its neighbours below it go to the least of them."""
    low = e.groupBy("a").agg(F.min("b").alias("m"))
    moved = F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
    return e.join(low, "a").select(F.inline(moved)).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (a, b: long): the smallest
    node that it reaches.  Loops and repeated edges do no harm; NULL ends are
    ignored; no edges give no rows."""
    e = saved(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
              "component-edges")
    state = None
    while True:
        give_back_driver_memory(edges.sparkSession)         # that of the plans before
        now = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
        e = saved(_small_star(_large_star(e)), "component-edges")
    stars = e.groupBy("a").agg(F.min("b").alias("b"))
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")) \
        .unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
