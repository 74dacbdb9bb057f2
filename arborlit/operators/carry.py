"""Values carried down an order: each row gets the last one given at or before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arborlit.sources.durable import durable


def carry_down(df: DataFrame, values: dict[str, Column], order: list[str], parts: int | None = None) -> DataFrame:
    """``df`` with a column for each of ``values``: the last value that isn't null, in ``order``, up to the row itself.

    Rows are sorted by ranges.  A window carries values within a range, the last
    of each range are carried on over the ranges, one row each, and fill what a
    range has before its first own value.  Null before any value; rows that
    ``order`` doesn't tell apart stand in any order; an empty table stays empty.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    given = df.withColumns({f"__{name}": F.struct(value.alias("v")) for name, value in values.items()}).repartitionByRange(parts, *order)
    placed = durable(given.withColumn("__part", F.spark_partition_id()))
    inside = W.partitionBy("__part").orderBy(*order)
    held = lambda name: F.when(F.col(f"__{name}.v").isNotNull(), F.col(f"__{name}.v"))
    filled = placed.withColumns({name: F.last(held(name), ignorenulls=True).over(inside) for name in values})
    last = placed.groupBy("__part").agg(*(F.max_by(F.col(f"__{name}.v"), F.when(F.col(f"__{name}.v").isNotNull(), F.struct(*order))).alias(f"__{name}") for name in values))
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    carried = last.select(F.col("__part"), *(F.last(f"__{name}", ignorenulls=True).over(before).alias(f"__before_{name}") for name in values))
    both = filled.join(F.broadcast(carried), "__part")  # a row a range
    return both.select(*df.columns, *(F.coalesce(name, f"__before_{name}").alias(name) for name in values))
