"""Pages of a sorted table that is stored in its order.

A table is sorted once and written in folders of consecutive rows, each a whole
number of pages.  A page is then a range of row numbers in one folder, and nothing
else is read or sorted for it.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from arborlit.functions import text as X
from arborlit.operators.explore import PAGE_ROWS
from arborlit.operators.intervals import numbered

FOLDER_PAGES = 4000


def store(rows: DataFrame, path: str, order: list[Column], size: int = PAGE_ROWS, folder_pages: int = FOLDER_PAGES) -> int:
    """Write ``rows`` in ``order`` and return how many pages of ``size`` rows there are, one at least."""
    held = numbered(rows, order).withColumn("folder", F.floor((F.col("number") - 1) / (size * folder_pages)))
    held.write.mode("overwrite").partitionBy("folder").parquet(f"{path}/rows")
    n = rows.sparkSession.read.schema("number long").parquet(f"{path}/rows").agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    pages = max(1, -(-n // size))
    rows.sparkSession.range(1).select(F.lit(pages).alias("pages"), F.lit(size).alias("size"), F.lit(folder_pages).alias("folder_pages"), F.lit(held.schema.json()).alias("schema")).write.mode("overwrite").json(f"{path}/about")
    return pages


def natural(key: str, descending: bool = False, ties: list[str] | None = None) -> list[Column]:
    """The order by ``key`` with digit runs by value, then by the columns ``ties``."""
    order = X.natural_key(key)
    return [order.desc() if descending else order.asc(), *(F.col(c) for c in ties or [])]


def page(spark: SparkSession, path: str, number: int) -> DataFrame:
    """Page ``number`` (from 0) of a stored table, with ``number``, its rows' places from 1; numbers beyond the last give the last, below 0 the first."""
    about = spark.read.schema("pages long, size int, folder_pages int, schema string").json(f"{path}/about").first()
    at = max(0, min(number, about.pages - 1))
    rows = spark.read.schema(StructType.fromJson(json.loads(about.schema))).parquet(f"{path}/rows").where(F.col("folder") == at // about.folder_pages)
    return rows.where(F.col("number").between(at * about.size + 1, (at + 1) * about.size)).drop("folder")
