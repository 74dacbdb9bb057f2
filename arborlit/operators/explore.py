"""The searchable, sortable, paged result table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborlit.functions import text as X

PAGE_ROWS = 25


def search(rows: DataFrame, query: str | None, columns: list[str] | None = None) -> DataFrame:
    return rows.where(X.matches_query(query, columns or rows.columns))


def naturally_sorted(rows: DataFrame, key: str | None, descending: bool = False, ties: list[str] | None = None) -> DataFrame:
    """By ``key``, digit runs by value; ties by the given columns."""
    if not key:
        return rows
    order = X.natural_key(key)
    return rows.orderBy(order.desc() if descending else order.asc(), *(ties or []))


def page_count(rows: DataFrame, size: int = PAGE_ROWS) -> int:
    return max(1, -(-rows.count() // size))


def page(rows: DataFrame, number: int, size: int = PAGE_ROWS, pages: int | None = None) -> DataFrame:
    """Page ``number`` (from 0) of sorted rows; numbers beyond the last give the last."""
    at = max(0, min(number, (pages if pages is not None else page_count(rows, size)) - 1))
    return rows.offset(at * size).limit(size)


def shown(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Some columns as text, a dash for values that are missing or blank."""
    return rows.select(*(F.coalesce(X.blank_to_null(F.col(f"`{c}`").cast("string")), F.lit("—")).alias(c) for c in columns))


def explore(rows: DataFrame, query: str | None = None, columns: list[str] | None = None, searchable: list[str] | None = None, sort: str | None = None, descending: bool = False, number: int = 0, size: int = PAGE_ROWS, ties: list[str] | None = None) -> DataFrame:
    """A page of the rows that match, naturally sorted."""
    columns = columns or rows.columns
    found = search(rows, query, searchable or columns)
    return shown(page(naturally_sorted(found, sort, descending, ties), number, size, page_count(found, size)), columns)
