"""Schemas of records, documents and bundles."""

from __future__ import annotations

from pyspark.sql import types as T


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


INFONS = "MAP<STRING, STRING>"
ANNOTATION = f"STRUCT<id: STRING, text: STRING, infons: {INFONS}>"
PASSAGE = f"STRUCT<text: STRING, infons: {INFONS}, annotations: ARRAY<{ANNOTATION}>>"
RECORD = f"STRUCT<id: STRING, pmid: STRING, pmcid: STRING, date: STRING, year: STRING, journal: STRING, doi: STRING, `article-id_doi`: STRING, authors: STRING, passages: ARRAY<{PASSAGE}>>"
CACHED = f"pmid STRING, record {RECORD}"

#: The columns of the document table, in order.
DOCUMENT_COLUMNS = ("pmid", "id", "pmcid", "date", "year", "month", "day", "journal", "doi", "authors", "title_e", "abstract", "search_title_e", "search_journal", "file_name", "source", "fetch_status", "failure_reason", "failed")
DOCUMENTS = strings(*DOCUMENT_COLUMNS)

#: The columns of the fact table.
FACT_COLUMNS = ("file_name", "id", "mesh_id", "ann_id", "key_category", "key_name", "key_text", "key_text1", "mesh_path", "web_id", "tree_id", "branch_index")

#: The columns of a bundle's document that stay blank when it is built.
BLANK_BUNDLE_COLUMNS = ("art_id", "yearR", "monthR", "dayR", "volumeJI", "yearJI", "monthJI", "dayJI", "lang", "doi2", "id", "cat", "hard_category", "format")
BUNDLE_COLUMNS = ("pmid", "title_e", "journal", "doi", "year", "month", "day", "authors", "subjects", "assigned_subjects1", "file_name", "number_citations", "factor", "relative_citation_ratio", "nih_percentile")

DATES = T.StructType([T.StructField("pmid", T.StringType()), T.StructField("dates", strings("date", "year", "month", "day"))])
