"""Connected components by alternating star contractions, on edges only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborlit.llm.session import durable


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for each node that has an edge.

    ``edges`` has two bigint columns ``a`` and ``b``.  Each round links every
    node's larger neighbours, then its smaller ones, to its smallest neighbour
    (Kiveris et al., 2014), until nothing changes; rounds grow with the logarithm
    of the longest chain.  Neighbour minima are partial aggregates, so a node with
    very many edges is no single task's work.  No edges: an empty table.
    """
    held = durable(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    before = None
    while True:
        both = held.unionAll(held.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        held = durable(large.join(small, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").where("a <> b").distinct())
        now = held.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = held.select(F.col("b").alias("node")).distinct()
    return held.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots.select("node", F.col("node").alias("component")))
