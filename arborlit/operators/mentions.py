"""Entity mentions from annotated records, and their branches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborlit.functions import text as X
from arborlit.sources import schemas as S


def mentions(records: DataFrame) -> DataFrame:
    """(pmid, ord, ann_id, kind, raw_identifier, term_id, text) for each annotation; ``ord`` is its place in the record.

    Passages and annotations that are missing vanish.  Keys may be capitalised.
    """
    base = [c for c in ("pmid", "ord") if c in records.columns]
    flat = records.select(*base, F.posexplode("record.passages").alias("passage_no", "p")).select(*base, "passage_no", F.posexplode("p.annotations").alias("ann_no", "a"))
    infon = lambda k: X.first_filled(F.col("a.infons")[k], F.col("a.infons")[k.capitalize()])
    order = F.struct(*([F.col("ord").alias("line")] if "ord" in base else []), "passage_no", "ann_no")
    rows = flat.select("pmid", order.alias("ord"), X.first_filled("a.id").alias("ann_id"), infon("type").alias("kind"), infon("identifier").alias("raw_identifier"), X.first_filled("a.text").alias("text"))
    return rows.withColumn("term_id", X.strip_prefix("raw_identifier"))


def of_kinds(rows: DataFrame, kinds: tuple[str, ...] | None) -> DataFrame:
    """Mentions of some kinds; all, if none are named."""
    return rows.where(F.col("kind").isin(*kinds)) if kinds else rows


def resolvable(rows: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Mentions whose kind and id the vocabulary may know."""
    return rows.where(F.col("kind").isin(*kinds) & X.is_term_id("term_id"))


def gene_mentions(rows: DataFrame) -> DataFrame:
    """(pmid, gene_id, ann_id, text, ord): a row for each gene id of each gene mention."""
    found = rows.where("kind = 'Gene'").select("pmid", F.posexplode(X.split_gene_ids("raw_identifier")).alias("k", "gene_id"), "ann_id", "text", "ord")
    return found.withColumn("ord", F.struct("ord", "k")).drop("k")


def facts(rows: DataFrame, branches: DataFrame, resolvable: tuple[str, ...] = ("Chemical", "Disease"), one_branch: bool = False) -> DataFrame:
    """The mentions with their branches: a row for each, or one with blanks for a mention without any.

    ``branches`` has term_id, branch_index, name, path_parts, tree_id and web_id.
    """
    if one_branch:
        branches = branches.where("branch_index = 0")
    can = F.col("kind").isin(*resolvable) & X.is_term_id("term_id")
    keyed = rows.withColumn("key", F.when(can, F.col("term_id")))
    joined = keyed.join(branches.withColumnRenamed("term_id", "key"), "key", "left")
    none = F.array().cast("array<string>")
    return joined.select(
        "pmid", "ord", "term_id", "ann_id", "kind", "text",
        F.coalesce("name", F.lit("")).alias("name"), F.coalesce("path_parts", none).alias("path_parts"),
        X.first_filled("web_id").alias("web_id"), X.first_filled("tree_id").alias("tree_id"), F.coalesce("branch_index", F.lit(0)).alias("branch_index"),
    )


def fact_table(rows: DataFrame) -> DataFrame:
    """The fact file's columns; lineages are joined by dots."""
    shown = {
        "file_name": X.file_label("pmid"), "id": F.col("pmid"), "mesh_id": F.col("term_id"), "ann_id": F.col("ann_id"), "key_category": F.lit("type"), "key_name": F.col("kind"),
        "key_text": F.col("text"), "key_text1": F.col("name"), "mesh_path": X.path_text("path_parts"), "web_id": F.col("web_id"), "tree_id": F.col("tree_id"), "branch_index": F.col("branch_index"),
    }
    return rows.select(*(shown[c].alias(c) for c in S.FACT_COLUMNS))


def subjects(rows: DataFrame, name: str = "name") -> DataFrame:
    """(pmid, names): a document's distinct names, in the order in which they first occur."""
    seen = rows.where(F.col(name) != "").groupBy("pmid", F.col(name).alias("n")).agg(F.min(F.struct("ord", "branch_index")).alias("o"))
    return seen.groupBy("pmid").agg(F.sort_array(F.collect_list(F.struct("o", "n"))).alias("s")).select("pmid", F.col("s.n").alias("names"))


def totals(genes: DataFrame) -> DataFrame:
    """(mentions, pairs, genes): rows, distinct (document, gene) pairs and distinct genes."""
    return genes.agg(F.count("*").alias("mentions"), F.count_distinct("pmid", "gene_id").alias("pairs"), F.count_distinct("gene_id").alias("genes"))


def gene_sets(genes: DataFrame) -> DataFrame:
    return genes.groupBy("pmid").agg(F.array_sort(F.collect_set("gene_id")).alias("gene_ids"))
