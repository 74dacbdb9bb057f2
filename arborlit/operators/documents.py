"""The document table: records joined with search rows and earlier dates, every id accounted for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborlit.functions import text as X
from arborlit.operators.latest import complete, last_wins, limit_first, not_done
from arborlit.sources import schemas as S


def passage_by_type(passages: Column, wanted: str) -> Column:
    """The text of the first passage of a type, in any case, blank or not; null without one."""
    return F.get(F.filter(passages, lambda p: F.lower(p["infons"]["type"]) == wanted.lower()), F.lit(0))["text"]


def people(value: Column) -> Column:
    """Authors as text; a JSON array of names is joined by ``; ``."""
    names = F.from_json(value, "array<string>")
    return F.when(F.startswith(F.ltrim(value), F.lit("[")) & names.isNotNull(), F.array_join(names, "; ")).otherwise(value)


def from_record(rows: DataFrame) -> DataFrame:
    """The document table's columns from (pmid, record, search_title, search_journal, dates, source, failure_reason).

    A null record is a failed row, whose title and journal are the search row's.
    """
    r = F.col("record")
    passages = F.coalesce(r["passages"], F.array().cast(f"array<{S.PASSAGE}>"))
    infons = F.get(passages, F.lit(0))["infons"]
    failed = r.isNull()
    journal = X.first_filled(infons["journal"], r["journal"], "search_journal")
    title = X.first_filled(passage_by_type(passages, "title"), F.get(passages, F.lit(0))["text"], "search_title_e")
    abstract = X.first_filled(passage_by_type(passages, "abstract"), F.get(passages, F.lit(1))["text"])
    of_record = lambda c: F.when(failed, F.lit("")).otherwise(c)
    rows = rows.withColumn("journal", F.when(failed, X.first_filled("search_journal")).otherwise(journal))
    dated = rows.withColumn("when", X.pick_date(F.col("dates"), X.record_date(r["date"]), X.journal_date("journal"), r["year"]))
    return dated.select(
        "pmid",
        of_record(X.first_filled(r["id"], "pmid")).alias("id"),
        of_record(X.first_filled(r["pmcid"], infons["article-id_pmc"])).alias("pmcid"),
        *(of_record(F.col("when")[k]).alias(k) for k in ("date", "year", "month", "day")),
        "journal",
        of_record(X.doi(r["doi"], r["article-id_doi"], F.col("journal"))).alias("doi"),
        of_record(X.first_filled(infons["authors"], people(r["authors"]))).alias("authors"),
        F.when(failed, X.first_filled("search_title_e")).otherwise(title).alias("title_e"),
        of_record(abstract).alias("abstract"),
        X.first_filled("search_title_e").alias("search_title_e"),
        X.first_filled("search_journal").alias("search_journal"),
        F.col("pmid").alias("file_name"),
        "source",
        F.when(failed, F.lit("failed")).otherwise(F.lit("ok")).alias("fetch_status"),
        F.when(failed, X.first_filled("failure_reason")).otherwise(F.lit("")).alias("failure_reason"),
        F.when(failed, F.lit("1")).otherwise(F.lit("0")).alias("failed"),
    )


def build_documents(
    search: DataFrame,
    cache: DataFrame,
    fetched: DataFrame | None = None,
    dates: DataFrame | None = None,
    previous: DataFrame | None = None,
    ids: DataFrame | None = None,
    limit: int | None = None,
    force: bool = False,
) -> DataFrame:
    """One row for each id of the search (or of ``ids``); rows of an earlier output that aren't redone stay.

    ``search`` has pmid, title_e, journal and ord, ``cache`` pmid and record,
    ``fetched`` pmid, record and reason (null record: the fetch failed for that
    reason), ``dates`` pmid and dates.  ``force`` ignores the cache and what is done.
    Of several search rows of an id the last one counts.
    """
    search = last_wins(search.select("pmid", *(F.col(c) if c in search.columns else F.lit("").alias(c) for c in ("title_e", "journal")), "ord"), ["pmid"], ["ord"])
    wanted = (ids.select("pmid").distinct().join(search.select("pmid", "ord"), "pmid", "left") if ids is not None else search.select("pmid", "ord"))
    wanted = limit_first(wanted, limit, ["ord", "pmid"]).select("pmid")
    todo = wanted if previous is None or force else not_done(wanted, previous)
    rows = todo.join(search.select("pmid", F.col("title_e").alias("search_title_e"), F.col("journal").alias("search_journal")), "pmid", "left")
    if force:
        cache = cache.limit(0)
    rows = rows.join(cache.where("record is not null").select("pmid", F.col("record").alias("cached")), "pmid", "left")
    if fetched is None:
        rows = rows.withColumn("got", F.col("cached")).withColumn("reason", F.lit("absent_from_response"))
    else:
        new = fetched.select("pmid", F.col("record").alias("new"), "reason")
        rows = rows.join(new.dropDuplicates(["pmid"]), "pmid", "left").withColumn("got", F.coalesce("cached", "new")).withColumn("reason", X.first_filled("reason", F.lit("absent_from_response")))
    source = F.when(F.col("cached").isNotNull(), F.lit("cache")).when(F.col("got").isNotNull(), F.lit("fetched")).otherwise(F.lit("search"))
    rows = rows.withColumn("source", source).withColumn("failure_reason", F.col("reason")).withColumn("record", F.col("got"))
    rows = rows.join(dates.select("pmid", "dates"), "pmid", "left") if dates is not None else rows.withColumn("dates", F.lit(None).cast("struct<date:string,year:string,month:string,day:string>"))
    out = from_record(rows.drop("cached", "got", "reason"))
    if previous is not None:
        kept = previous.select(*S.DOCUMENT_COLUMNS).join(todo, "pmid", "left_anti")
        out = out.unionByName(kept)
    return complete(wanted, out)


def failed_ids(documents: DataFrame) -> DataFrame:
    return documents.where("fetch_status = 'failed'").select("pmid", "failure_reason")


def run_status(documents: DataFrame) -> DataFrame:
    """(ok, failed, total)."""
    return documents.agg(F.count_if(F.col("fetch_status") == "ok").alias("ok"), F.count_if(F.col("failed") == "1").alias("failed"), F.count("*").alias("total"))


def bundle_documents(documents: DataFrame, subjects: DataFrame, citations: DataFrame | None = None, order: str | None = None) -> DataFrame:
    """The bundle's documents: those with status ok, their subjects and metrics, blanks elsewhere."""
    rows = documents.where("fetch_status = 'ok'").join(subjects.select("pmid", "names"), "pmid", "left")
    rows = rows.withColumn("subjects", X.subjects_text(F.coalesce("names", F.array().cast("array<string>"))))
    metrics = {"number_citations": "citation_count", "factor": "openalex_2yr_mean_citedness", "relative_citation_ratio": "relative_citation_ratio", "nih_percentile": "nih_percentile"}
    if citations is not None:
        rows = rows.join(citations.select("pmid", *(F.col(c).cast("string").alias(f"__{k}") for k, c in metrics.items())), "pmid", "left")
    value = lambda k: X.first_filled(f"__{k}") if citations is not None else F.lit("")
    out = [*(X.first_filled(c).alias(c) for c in ("pmid", "title_e", "journal", "doi", "year", "month", "day", "authors", "subjects")), F.col("subjects").alias("assigned_subjects1"), F.col("pmid").alias("file_name")]
    return rows.select(*out, *(value(k).alias(k) for k in metrics), *(F.lit("").alias(c) for c in S.BLANK_BUNDLE_COLUMNS))
