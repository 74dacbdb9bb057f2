"""Interval labels of a hierarchy, and distinct counts that add up along it.

Nodes are numbered in the order of their paths' components, so that a node and
all below it have consecutive numbers: "below a node" is a range of one number,
which a scan can skip files by, instead of a comparison of paths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arborlit.functions import text as X
from arborlit.sources.durable import durable


def numbered(df: DataFrame, order: list[Column | str], name: str = "number") -> DataFrame:
    """``df`` with ``name``: the place of each row in a distributed sort, from 1.

    Rows are sorted by ranges and written once; a row's place is that in its
    partition plus the sizes of the partitions before, one number a partition.
    Without an ``order`` rows are in it already, as those of a bundle's arrays are.
    """
    placed_rows = df.orderBy(*order) if order else df
    sorted_rows = durable(placed_rows.withColumns({"__part": F.spark_partition_id(), "__place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}))
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sorted_rows.groupBy("__part").count().select("__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__before"))
    return sorted_rows.join(F.broadcast(offsets), "__part").select(*df.columns, (F.col("__before") + F.col("__place") + 1).alias(name))  # a row a partition


def parts_of(path: Column | str) -> Column:
    return F.split(X.col(path), r"\.")


def labels(paths: DataFrame) -> DataFrame:
    """(path, low, high, depth) of every node on the dotted ``path`` of some row: its number, and the highest below it.

    A node x is at or below y exactly if y.low <= x.low <= y.high.  Blank and null
    paths have no node; repeats don't matter; work is a row for each node and its
    ancestors, whatever the number of documents.
    """
    distinct = paths.where(X.first_filled("path") != "").select("path").distinct()
    nodes = distinct.select(F.explode(X.prefixes(parts_of("path"))).alias("parts")).distinct()
    placed = numbered(nodes, ["parts"], "low")
    sizes = nodes.select(F.explode(X.prefixes(F.col("parts"))).alias("parts")).groupBy("parts").agg(F.count("*").alias("size"))
    return placed.join(sizes, "parts").select(F.array_join("parts", ".").alias("path"), "low", (F.col("low") + F.col("size") - 1).alias("high"), F.size("parts").alias("depth"))


def chains(held: DataFrame) -> DataFrame:
    """(low, chain): for each node the numbers of the nodes down to it, itself the last."""
    steps = held.select("low", F.explode(F.transform(X.prefixes(parts_of("path")), lambda p: F.array_join(p, "."))).alias("path"))
    found = steps.join(held.select("path", F.col("low").alias("above")), "path")
    return found.groupBy("low").agg(F.sort_array(F.collect_list("above")).alias("chain"))  # as many as the node is deep


def distinct_below(pairs: DataFrame, key: str, held: DataFrame) -> DataFrame:
    """(path, n): at or below how many distinct ``key`` each node has, exact, from ``pairs`` (path, key).

    Ids are shuffled once, with the numbers of their paths.  In the order of
    numbers each distinct path adds one at its node, and each two neighbours take
    one away where they part; the sum below a node is then the number of distinct
    ids there, as within a subtree an id has one path more than places where
    neighbours part (Hui, 1992).  These sums are additive, so one row a node is
    left before anything goes up the hierarchy, however deep it is or many ids
    there are.  Null ids don't count, paths that ``held`` doesn't have are left
    out, repeats don't matter.
    """
    rows = placed(pairs.where(F.col(key).isNotNull()).select("path", F.col(key).alias("key")), held)
    before = rows.select("low", F.lag("low").over(W.partitionBy("key").orderBy("low")).alias("before"))
    chain = _dimension(durable(chains(held)))
    chained = before.where("before is null or before <> low").join(chain, "low").join(chain.select(F.col("low").alias("before"), F.col("chain").alias("other")), "before", "left")
    parting = F.array_max(F.array_intersect("chain", "other"))  # deeper nodes have higher numbers
    deltas = chained.select(F.inline(F.array(F.struct(F.col("low").alias("node"), F.lit(1).alias("d")), F.struct(parting.alias("node"), F.lit(-1).alias("d")))))
    sums = deltas.where("node is not null").groupBy("node").agg(F.sum("d").alias("d"))  # a row a node
    up = sums.join(chain, F.col("node") == F.col("low")).select(F.explode("chain").alias("low"), "d").groupBy("low").agg(F.sum("d").alias("n"))
    return held.select("path", "low").join(up, "low").select("path", "n")


def placed(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """``pairs`` (path, ...) with the number of their path, ``low``, in its place."""
    return pairs.join(_dimension(held.select("path", "low")), "path").drop("path")


def below(rows: DataFrame, held: DataFrame, path: str, number: str = "low") -> DataFrame:
    """The ``rows`` whose ``number`` lies at or below the node ``path``; none, if there is no such node."""
    found = held.where(F.col("path") == path).select("low", "high").first()
    return rows.where(F.col(number).between(found.low, found.high)) if found else rows.where("false")


def _dimension(df: DataFrame) -> DataFrame:
    from arborlit.operators.latest import dimension

    return dimension(df)
