"""Exact top-k search by inner product with MaxScore pruning.

Rows are dealt into shards of bounded size.  A shard holds two posting lists for
each dimension, ordered by impact: for queries whose component is positive from the
greatest value down, for negative ones from the least up.  Values are taken from
the list's far end, so that every contribution is 0 or more, and a list is cut
into ``SEGMENTS`` segments; a segment's bound is what its first posting adds.

For a query, segments are taken from the lists' heads, those that lower the bound
most first, until what a row in none of them can reach, the sum of the bounds of
each list's next segment, is below the threshold: the k-th best score of some
leading rows.  The segments taken are essential: a row in none of them can't be
among the k best and is never looked at.  Essential postings are traversed and
add up; a row goes on only if its sum, with the other lists' bounds, reaches the
threshold.  Those rows are probed in the dimensions one block at a time, while they stay
competitive, and the threshold rises as scores are completed.  So results are
exact; shards' results are merged by score, then smaller id.

Where every dimension matters alike, as in evenly spread vectors, nearly every
row is in an essential segment and only the bounds of the later steps save work;
clustered vectors leave most rows out.  :func:`work` tells.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arborlit.llm.session import durable

SHARD_ROWS = 4096
QUERY_ROWS = 4096
BLOCK = 8
LEADERS = 8
SEGMENTS = 32


class Shard:
    """The posting lists of some vectors, ordered by impact, with their segments' bounds."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.lists = ids[order], np.ascontiguousarray(vectors[order].T)
        self.least, self.most = self.lists.min(axis=1), self.lists.max(axis=1)
        self.up = np.argsort(self.lists, axis=1, kind="stable").astype(np.int32)  # the rows of each list, least value first
        n = len(ids)
        self.cuts = np.unique(np.arange(SEGMENTS + 1) * n // SEGMENTS)
        heads = self.cuts[:-1]
        ordered = np.take_along_axis(self.lists, self.up, axis=1)
        self.high = ordered[:, n - 1 - heads] - self.least[:, None]  # bounds of the segments from the greatest value down
        self.low = self.most[:, None] - ordered[:, heads]  # and from the least up
        self.seen = self.essential = self.probed = 0

    def candidates(self, query: np.ndarray, bar: float) -> np.ndarray:
        """The rows that essential postings leave: any other row's score is below ``bar``, counted from the least possible."""
        weight = np.abs(query)
        bounds = weight[:, None] * np.where((query >= 0)[:, None], self.high, self.low)
        open_ = bounds[:, 0].sum()
        if open_ < bar:
            return np.zeros(0, dtype=np.int64)
        gain = bounds[:, :-1] - bounds[:, 1:]
        # a list's segments are taken in order, so none goes before one nearer to the head
        order = np.argsort(-np.minimum.accumulate(gain, axis=1), axis=None, kind="stable")
        left = open_ - np.cumsum(gain.reshape(-1)[order])
        enough = np.flatnonzero(left < bar)
        if not len(enough):
            self.essential += len(self.ids)
            return np.arange(len(self.ids))
        taken = np.bincount(order[: enough[0] + 1] // gain.shape[1], minlength=len(query))
        rest = bounds[np.arange(len(query)), taken]
        reach, met = np.full(len(self.ids), rest.sum()), np.zeros(len(self.ids), dtype=bool)
        for k in np.flatnonzero(taken).tolist():
            many = self.cuts[taken[k]]
            rows = self.up[k, len(self.ids) - many :] if query[k] >= 0 else self.up[k, :many]
            value = self.lists[k, rows]
            reach[rows] += weight[k] * (value - self.least[k] if query[k] >= 0 else self.most[k] - value) - rest[k]
            met[rows] = True
        self.essential += int(met.sum())
        return np.flatnonzero(met & (reach >= bar))

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best rows for ``query``, without the row ``own``; the best first, ties to smaller ids."""
        bound, floor = np.maximum(query * self.least, query * self.most), np.minimum(query * self.least, query * self.most)
        order = np.argsort(floor - bound, kind="stable")  # the list that tells most first
        left = np.append(np.cumsum(bound[order][::-1])[::-1], 0)
        strong = order[:BLOCK]
        lead = min(LEADERS, len(self.ids))
        seeds = np.unique(np.where((query[strong] > 0)[:, None], self.up[strong, len(self.ids) - lead :], self.up[strong, :lead]))
        seeds = seeds[self.ids[seeds] != own]
        least = self._kth(query @ self.lists[:, seeds], k)
        rows = self.candidates(query, least - floor.sum()) if least > -np.inf else np.arange(len(self.ids))
        rows = rows[self.ids[rows] != own]
        self.seen, self.probed = self.seen + len(self.ids), self.probed + len(rows)
        score, at = np.zeros(len(rows), dtype=self.lists.dtype), 0
        while at < len(order) and len(rows):
            block = order[at : at + BLOCK]
            score = score + query[block] @ self.lists[np.ix_(block, rows)]
            at += len(block)
            if len(rows) > 4 * k and at < len(order):  # complete the most promising rows: the threshold rises
                best = np.argpartition(-score, k)[: k + 1]
                least = max(least, self._kth(query @ self.lists[:, rows[best]], k))
            keep = score + left[at] >= least
            rows, score = rows[keep], score[keep]
        best = np.lexsort((self.ids[rows], -score))[:k]
        return self.ids[rows[best]], score[best]

    @staticmethod
    def _kth(scores: np.ndarray, k: int) -> float:
        return -np.inf if len(scores) < k else float(np.partition(scores, len(scores) - k)[len(scores) - k])


def quantised(vectors: Column) -> Column:
    """floor(256 * x) of each component x as double."""
    return F.transform(vectors, lambda x: F.floor(x.cast("double") * 256))


def usable(vectors: Column) -> Column:
    """Whether a vector and its components are neither null nor infinite nor NaN."""
    return vectors.isNotNull() & F.forall(vectors, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of a list column, zeros after shorter ones; exact in double precision unless values are huge."""
    column = column.combine_chunks()
    size = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(size), width), dtype=np.int64)
    out[np.arange(width) < size[:, None]] = values
    return out


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of greatest inner product for each query, itself left out.

    ``vectors`` has vec_id (bigint) and embedding (array of numbers), ``is_query``
    is a predicate on vec_id.  Components become floor(256 * x) as long.  Rows
    with a null vec_id, or a vector that is null or holds a null, NaN or infinite
    component, take no part; shorter vectors end in zeros; of rows that repeat a
    vec_id the least vector stays.  Fewer than ``k`` other rows: all of them.
    Equal scores: the smaller vec_id first.  Other columns are ignored; an empty
    table gives an empty result.

    Tasks are cells of (shard, block of queries); each shard goes to every block
    of ``QUERY_ROWS`` queries and each query to every shard.
    """
    found = _cells(vectors, is_query, k).where("seen is null").drop("seen", "essential", "probed")
    best = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def work(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """(seen, essential, probed) of :func:`top_k`, one row: pairs of a query and a row, those met in essential segments, and those probed."""
    return _cells(vectors, is_query, k).where("seen is not null").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("seen", "essential", "probed")))


def _cells(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """(query_id, vec_id, score): each shard's best for each query; and a row of each cell with its work, where those are null."""
    held = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    held = durable(held.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min(quantised(F.col("embedding"))).alias("v")))
    rows, width, asked = held.agg(F.count("*"), F.max(F.size("v")), F.count_if(is_query)).first()
    shards, groups, width = max(1, -(-rows // SHARD_ROWS)), max(1, -(-asked // QUERY_ROWS)), width or 0
    hashed = F.xxhash64("vec_id")
    candidates = held.select(F.pmod(hashed, F.lit(shards)).alias("shard"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("part"), F.lit(False).alias("asks"), "vec_id", "v")
    queries = held.where(is_query).select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"), F.pmod(hashed, F.lit(groups)).alias("part"), F.lit(True).alias("asks"), "vec_id", "v")

    def cell(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        ids, matrix = table.column("vec_id").to_numpy(), _matrix(table.column("v"), width)
        largest = float(np.abs(matrix).max(initial=0))
        if largest * largest * max(1, width) < 2**53:
            matrix = matrix.astype(np.float64)  # sums stay exact
        out: list[tuple[int, np.ndarray, np.ndarray]] = []
        work = [0, 0, 0]
        if asks.any() and not asks.all():
            shard = Shard(ids[~asks], matrix[~asks])
            for own, query in zip(ids[asks].tolist(), matrix[asks], strict=True):
                found, score = shard.search(query, own, k)
                out.append((own, found, score))
            work = [shard.seen, shard.essential, shard.probed]
        size = [len(x[1]) for x in out]
        flat = lambda n: np.concatenate([x[n] for x in out]).astype(np.int64) if out else np.zeros(0, dtype=np.int64)
        n, names = sum(size), ("seen", "essential", "probed")
        best = {"query_id": pa.array(np.repeat(np.array([x[0] for x in out], dtype=np.int64), size)), "vec_id": pa.array(flat(1)), "score": pa.array(flat(2)), **{c: pa.nulls(n, pa.int64()) for c in names}}
        told = {**{c: pa.nulls(1, pa.int64()) for c in ("query_id", "vec_id", "score")}, **{c: pa.array([x], pa.int64()) for c, x in zip(names, work, strict=True)}}
        return pa.concat_tables([pa.table(best), pa.table(told)])

    return candidates.unionByName(queries).groupBy("shard", "part").applyInArrow(cell, "query_id long, vec_id long, score long, seen long, essential long, probed long")
