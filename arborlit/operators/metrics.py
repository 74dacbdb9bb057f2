"""Citation metrics by two-hop lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborlit.functions import text as X


def citation_table(documents: DataFrame, metrics: DataFrame, works: DataFrame, sources: DataFrame) -> DataFrame:
    """One row for each document: its own metrics, and those of the source of its work.

    The three lookups are (key, value) tables with struct values; a null value
    means that nothing is known.
    """
    ids = documents.where("fetch_status = 'ok'").select("pmid")
    rows = ids.join(metrics.select(F.col("key").alias("pmid"), F.col("value").alias("m")), "pmid", "left")
    rows = rows.join(works.select(F.col("key").alias("pmid"), F.col("value.source_id").alias("source_id")), "pmid", "left")
    rows = rows.join(sources.select(F.col("key").alias("source_id"), F.col("value").alias("s")), "source_id", "left")
    return rows.select("pmid", "m.citation_count", "m.relative_citation_ratio", "m.nih_percentile", F.col("s.display_name").alias("openalex_journal_name"), F.col("s.two_yr_mean_citedness").alias("openalex_2yr_mean_citedness"))


def missing_keys(wanted: DataFrame, cache: DataFrame) -> DataFrame:
    """(key): what isn't in a cache yet; keys known to be absent are in it."""
    return wanted.select("key").where("key is not null and key <> ''").distinct().join(cache.select("key"), "key", "left_anti")


def work_sources(works: DataFrame) -> DataFrame:
    """(key): the distinct sources of works."""
    return works.select(F.col("value.source_id").alias("key")).where("key is not null and key <> ''").distinct()


def source_id(url: Column | str) -> Column:
    """The id at the end of a source's address."""
    return X.id_tail(url)
