"""Positions in a distributed sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arborlit.llm.session import durable

INDEX_BITS = 33  # of monotonically_increasing_id: the place within a partition


def positions(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` sorted by ``order``, with its ``position`` from 1.

    Rows are sorted by ranges and written once; a row's position is its place
    within its partition plus the sizes of the partitions before, one number a
    partition.  Rows that ``order`` doesn't tell apart stand in any order.
    """
    placed = durable(df.orderBy(*order).withColumns({"__part": F.spark_partition_id(), "__place": F.monotonically_increasing_id()}))
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    offsets = placed.groupBy("__part").agg(F.count("*").alias("__rows")).select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    place = F.col("__place").bitwiseAND(F.lit((1 << INDEX_BITS) - 1))
    return placed.join(F.broadcast(offsets), "__part").select(*df.columns, (F.col("__before") + place + 1).alias("position"))  # a row a partition
