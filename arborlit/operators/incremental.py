"""Subjects for documents that have none yet, on top of a committed tree."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborlit.functions import text as X
from arborlit.operators import mentions as M
from arborlit.operators import trees, vocabulary
from arborlit.operators.latest import in_list_order, limit_first


@dataclass(frozen=True)
class Enriched:
    """The new state: documents with subjects, the merged tree, and the facts to append."""

    documents: DataFrame
    tree: DataFrame
    facts: DataFrame
    unresolved: DataFrame


def targets(documents: DataFrame, ids: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """(pmid): the listed documents, in the list's order, else those without subjects."""
    if ids:
        found = in_list_order(documents, ids).select("pmid", F.col("ordinal").cast("long").alias("place"))
    else:
        found = documents.where((X.first_filled("subjects") == "") & (X.first_filled("pmid") != "")).select("pmid", F.col("ord").cast("long").alias("place"))
    return limit_first(found, limit, ["place", "pmid"]).select("pmid")


def enrich_subjects(documents: DataFrame, tree: DataFrame, records: DataFrame, vocabulary_branches: DataFrame, ids: list[str] | None = None, limit: int | None = None, kinds: tuple[str, ...] = ("Chemical", "Disease")) -> Enriched:
    """Resolve the targets' mentions, first by the tree's own branches, then by the vocabulary.

    ``documents`` has pmid, subjects and ord, ``tree`` mesh_id, path, n, web_id,
    tree_id and ord.  Counts are added to the tree's; documents that get no
    subject stay as they are; terms known nowhere are reported.
    """
    wanted = targets(documents, ids, limit)
    rows = M.mentions(records.join(wanted, "pmid", "left_semi")).where(F.col("kind").isin(*kinds) & X.is_term_id("term_id"))
    known = vocabulary.branches_of_tree(tree)
    more = vocabulary_branches.join(known.select("term_id").distinct(), "term_id", "left_anti")
    found = M.facts(rows, known.unionByName(more), kinds)
    new = trees.mention_tree(found).withColumnRenamed("term_id", "mesh_id")
    old = tree.where((X.first_filled("mesh_id") != "") & (X.first_filled("path") != "")).select("mesh_id", "path", "n", "web_id", "tree_id")
    names = M.subjects(found)
    filled = documents.join(names, "pmid", "left")
    subjects = F.when(F.size("names") > 0, X.subjects_text("names")).otherwise(F.col("subjects"))
    kept = [c for c in documents.columns if c not in ("subjects", "assigned_subjects1")]
    assigned = [F.when(F.size("names") > 0, X.subjects_text("names")).otherwise(F.col("assigned_subjects1")).alias("assigned_subjects1")] if "assigned_subjects1" in documents.columns else []
    return Enriched(filled.select(*kept, subjects.alias("subjects"), *assigned), trees.merge_counts(old, new, ("mesh_id", "path")), M.fact_table(found), found.where("name = ''").select("term_id").distinct())
