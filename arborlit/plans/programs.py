"""Whole programs: what a user runs, from tables to bundles."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborlit.functions import text as X
from arborlit.operators import classify, documents, incremental, mentions, metrics, ontology, trees, vocabulary
from arborlit.operators.latest import last_wins, limit_first
from arborlit.sources import readers, remote, sinks
from arborlit.sources.durable import durable, stored

KINDS = ("Chemical", "Disease")


@dataclass(frozen=True)
class Built:
    """The facts, the tree's entries and the documents of a bundle."""

    facts: DataFrame
    tree: DataFrame
    documents: DataFrame


def limited(records: DataFrame, limit: int | None) -> DataFrame:
    """The first records of a scan; all, without a limit."""
    return limit_first(records, limit, ["ord"] if "ord" in records.columns else ["pmid"])


def build_tree(
    records: DataFrame,
    descriptors: DataFrame,
    supplements: DataFrame | None = None,
    docs: DataFrame | None = None,
    citations: DataFrame | None = None,
    kinds: tuple[str, ...] | None = KINDS,
    one_branch: bool = False,
    limit: int | None = None,
) -> Built:
    """Vocabulary tree, facts and documents from records.

    ``records`` has pmid and record, with ``ord`` if lines that repeat an id are
    to count again (``readers.all_records``); ``readers.cached_records`` gives the
    last line of each id only.  ``kinds`` None keeps mentions of every kind as
    facts; only those in ``KINDS`` are resolved.
    """
    found = mentions.of_kinds(mentions.mentions(limited(records, limit)), kinds)
    branches = vocabulary.term_branches(descriptors, supplements)
    facts = mentions.facts(found, branches, KINDS, one_branch)
    known = branches.where("branch_index = 0") if one_branch else branches
    tree = trees.ordered_tree(trees.term_tree(mentions.resolvable(found, KINDS), known), "term_id")
    bundle = None if docs is None else documents.bundle_documents(docs, mentions.subjects(facts), citations)
    return Built(mentions.fact_table(facts), trees.tree_entries(tree, "term_id", "mesh_id"), bundle)


def gene_trees(records: DataFrame, references: dict[str, DataFrame], docs: DataFrame, approaches: str = "terms,groups,pathways,types", organism: str = "hsa", limit: int | None = None) -> dict[str, Built]:
    """A tree and its documents for each classification that is asked for.

    ``references`` holds ``terms`` (gene_id, class_id) and ``ontology``, ``groups``
    (gene_id, path_parts), ``pathways`` (gene_id, class_id) and ``outline``
    (class_id, path_parts), ``types`` (gene_id, class_id), as the readers give
    them.  Records are read once and shared.
    """
    genes = stored(mentions.gene_mentions(mentions.mentions(limited(records, limit))))
    counts, out = durable(trees.gene_counts(genes)), {}
    for kind in trees.known_approaches(approaches):
        paths = None
        if kind == "terms":
            paths = ontology.dag_lineages(references["ontology"], references["terms"].join(counts, "gene_id", "left_semi").select(F.col("class_id").alias("term_id")))
        elif kind == "pathways":
            paths = references["outline"]
        tree, names = trees.gene_tree(genes, trees.gene_classes(kind, references[kind], paths, organism), counts)
        out[kind] = Built(genes, trees.tree_entries(trees.ordered_tree(tree, "gene_id"), "gene_id", "gene_id"), trees.gene_documents(docs, genes, names))
    return out


def merge_reference(docs: DataFrame, reference: DataFrame, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Documents with blank categories filled from a reference's, and what was filled."""
    from arborlit.sources.readers import matching_docs

    wanted = limit_first(docs.where(X.first_filled("pmid") != ""), limit, ["ord"] if "ord" in docs.columns else ["pmid"])
    filled = trees.fill_blanks(docs, matching_docs(reference, wanted))
    return filled.drop("filled_cat", "filled_hard_category", "filled_format"), trees.fill_counts(filled)


def fetch_documents(
    spark: SparkSession,
    search: DataFrame,
    cache: str,
    out: str,
    fetch: Callable[[list[str]], str] | DataFrame,
    failed: str | None = None,
    dates: DataFrame | None = None,
    ids: DataFrame | None = None,
    limit: int | None = None,
    force: bool = False,
    **options,
) -> DataFrame:
    """Fetch what is missing, write the document table and the failed ids, and return the run's status (ok, failed, total).

    What isn't in the cache is fetched into a log beside it, task by task
    (:func:`remote.fetch_into`), and appended to the cache when all is there; what
    a run that broke off left in the log counts as held.  ``fetch`` may also be
    answers on record (:func:`remote.recorded_records`).  ``ids`` (say the failed
    ones of an earlier run, ``readers.id_list``) names the ids to redo; ``force``
    fetches all anew.
    """
    wanted = ids if ids is not None else last_wins(search.select("pmid", "ord"), ["pmid"], ["ord"])
    wanted = durable(limit_first(wanted, limit, ["ord"] if "ord" in wanted.columns else ["pmid"]).select("pmid").distinct())
    previous, log = readers.existing_output(spark, out), f"{cache}.log"
    left = durable(remote.logged(spark, log).where("record is not null").select("pmid", "record"))  # by a run that broke off
    if not left.isEmpty():
        sinks.append_cache(left, cache)
    held = readers.cached_records(spark, cache)  # files as they are before this run
    sinks.remove(spark, log)
    pending = wanted if force else wanted.join(previous.where("fetch_status = 'ok'").select("pmid"), "pmid", "left_anti").join(held.select("pmid"), "pmid", "left_anti")
    pending = durable(pending)
    if isinstance(fetch, DataFrame):
        got = durable(remote.recorded_records(pending, fetch, **options))
    else:
        remote.fetch_into(log, pending, fetch, **options)
        got = durable(remote.logged(spark, log))
    done = durable(documents.build_documents(search, held, got, dates, previous, wanted, force=force))
    sinks.append_cache(got.where("record is not null").select("pmid", "record"), cache)
    sinks.remove(spark, log)
    sinks.write_documents(done, out)
    if failed:
        sinks.write_failed(done, failed)
    return documents.run_status(done)


def enrich_citations(docs: DataFrame, caches: dict[str, str], fetch: dict[str, Callable[[list[str]], dict] | DataFrame], **options) -> DataFrame:
    """The citation table of documents; what the caches lack is fetched, or taken from answers on record, and appended to them first.

    ``caches`` and ``fetch`` have ``metrics`` (citation_count,
    relative_citation_ratio, nih_percentile by pmid), ``works`` (source_id by pmid)
    and ``sources`` (display_name, two_yr_mean_citedness by source_id).
    """
    spark = docs.sparkSession
    kinds = {"metrics": "STRUCT<citation_count: BIGINT, relative_citation_ratio: DOUBLE, nih_percentile: DOUBLE>", "works": "STRUCT<source_id: STRING>", "sources": "STRUCT<display_name: STRING, two_yr_mean_citedness: DOUBLE>"}
    held: dict[str, DataFrame] = {}
    for name, value in kinds.items():
        wanted = metrics.work_sources(held["works"]) if name == "sources" else docs.where("fetch_status = 'ok'").select(F.col("pmid").alias("key"))
        missing = durable(metrics.missing_keys(wanted, readers.key_values(spark, caches[name], value)))
        if not missing.isEmpty():
            source = fetch[name]
            new = durable(remote.recorded_values(missing, source, value) if isinstance(source, DataFrame) else remote.fetch_values(missing, source, value, **options))
            new.write.mode("append").option("ignoreNullFields", False).json(caches[name])
        held[name] = readers.key_values(spark, caches[name], value)
    return metrics.citation_table(docs, held["metrics"], held["works"], held["sources"])


def predict_into(docs: DataFrame, targets: tuple[str, ...] = ("hard_category", "format"), limit: int | None = None, **options) -> tuple[DataFrame, dict[str, DataFrame]]:
    """``docs`` with <target>_predicted and <target>_predicted_confidence for every target, and the reports of the models.

    Models are trained on all labelled documents; ``limit`` takes a sample of that
    many documents to predict.  Documents that have a label, have no content or
    aren't in the sample get a blank and null, as does a target with too few labels.
    """
    out, reports = docs, {}
    asked = classify.sample(docs, limit) if limit else docs
    for target in targets:
        trained = classify.train(docs, target, **options)
        if trained is None:
            out = out.withColumn(f"{target}_predicted", F.lit("")).withColumn(f"{target}_predicted_confidence", F.lit(None).cast("double"))
            continue
        reports[target] = trained.report
        found = last_wins(durable(classify.predict(trained, asked, target)), ["pmid"], [f"{target}_predicted"])
        out = out.join(found, "pmid", "left").na.fill("", [f"{target}_predicted"])
    return out, reports


def split_bundles(tree: DataFrame, docs: DataFrame, path: str, split_all: bool = False) -> DataFrame:
    """One bundle a bucket, a folder named by its slug, with the bucket's tree and the documents that name a leaf of it; returns (bucket, slug, entries)."""
    bucketed, trimmed = (durable(x) for x in trees.split_tree(tree, docs, split_all))
    sizes = durable(trees.bucket_sizes(bucketed))
    for row in sizes.collect():  # top-level categories, some twenty
        entries = trees.tree_entries(bucketed.where(F.col("bucket") == row.bucket), "mesh_id", "mesh_id")
        sinks.write_bundle_parts(entries, trimmed.where(F.col("bucket") == row.bucket).drop("bucket"), f"{path}/{row.slug}.json")
    return sizes


def upkeep_report(before: DataFrame, after: incremental.Enriched) -> DataFrame:
    """What an incremental run would change (nothing is written): documents that get subjects, facts, the tree's entries, unknown terms."""
    given = after.documents.where(X.first_filled("subjects") != "").join(before.where(X.first_filled("subjects") == "").select("pmid"), "pmid", "left_semi")
    count = lambda df, name: df.agg(F.count("*").alias(name))
    out = count(given, "documents")
    for df, name in ((after.facts, "facts"), (after.tree, "tree_entries"), (after.unresolved, "unresolved")):
        out = out.crossJoin(count(df, name))  # one row each
    return out
