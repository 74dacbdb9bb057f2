"""Latest row by key, first-seen distinct, completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that comes last by ``order``.

    A maximum over a struct is a partial aggregate, so a key with very many rows
    is reduced before it is shuffled.
    """
    rest = [c for c in df.columns if c not in keys]
    found = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return found.select(*(F.col(f"__row.{c}").alias(c) if c in rest else F.col(c) for c in df.columns))


def first_seen(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that comes first by ``order``."""
    rest = [c for c in df.columns if c not in keys]
    found = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return found.select(*(F.col(f"__row.{c}").alias(c) if c in rest else F.col(c) for c in df.columns))


def with_order(df: DataFrame) -> DataFrame:
    """``ord``: the position of a row in its scan, files by name, then the order inside a file."""
    return df.withColumn("ord", F.struct(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("line")))


def limit_first(df: DataFrame, n: int | None, order: list[str]) -> DataFrame:
    """The first ``n`` rows by ``order``; all, if None or 0."""
    return df.orderBy(*order).limit(n) if n else df


def batch_number(df: DataFrame, size: int, order: list[str]) -> DataFrame:
    """``batch``: rows numbered by ``order`` in batches of ``size``, from 1.

    Ranks come from range partitions and their sizes, not from one global window.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id())
    sizes = ordered.groupBy("__part").count()
    before = sizes.select("__part", (F.sum("count").over(W.orderBy("__part")) - F.col("count")).alias("__before"))
    inside = F.row_number().over(W.partitionBy("__part").orderBy(*order)) - 1
    numbered = ordered.join(F.broadcast(before), "__part").withColumn("__at", F.col("__before") + inside)
    return numbered.withColumn("batch", (F.floor(F.col("__at") / size) + 1).cast("long")).drop("__part", "__before", "__at")


def not_done(ids: DataFrame, previous: DataFrame, key: str = "pmid") -> DataFrame:
    """Ids without an ``ok`` row in an earlier output."""
    return ids.join(previous.where("fetch_status = 'ok'").select(key).distinct(), key, "left_anti")


def in_list_order(df: DataFrame, ids: list[str], key: str = "pmid") -> DataFrame:
    """Rows whose key is listed, with ``ordinal``, the key's first place in the list."""
    places = {}
    for k, x in enumerate(ids):
        places.setdefault(x.strip(), k)
    places.pop("", None)
    listed = df.sparkSession.createDataFrame(list(places.items()), f"{key} string, ordinal int")
    return df.join(F.broadcast(listed), key)


def complete(ids: DataFrame, rows: DataFrame, missing: Column | None = None, key: str = "pmid") -> DataFrame:
    """``rows``, and for each id without one a failed row."""
    lost = ids.select(key).distinct().join(rows.select(key).distinct(), key, "left_anti")
    reason = missing if missing is not None else F.lit("missing_from_output")
    return rows.unionByName(lost.select(key, F.lit("failed").alias("fetch_status"), reason.alias("failure_reason"), F.lit("1").alias("failed"), F.col(key).alias("file_name")), allowMissingColumns=True).na.fill("", [c for c in rows.columns if dict(rows.dtypes)[c] == "string"])


def dimension(df: DataFrame, most_rows: int = 200_000) -> DataFrame:
    """``df`` with a broadcast hint if it has few rows; beyond that the join is left to shuffle."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df
