"""Category trees: counts by term and path, assembling, splitting, merging."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborlit.functions import text as X


def mention_tree(facts: DataFrame) -> DataFrame:
    """(term_id, path, n, web_id, tree_id): how many mentions lie on each branch of a term; the last ids win."""
    rows = facts.where(F.size("path_parts") > 0).withColumn("path", X.path_text("path_parts"))
    order = F.struct("pmid", "ord", "branch_index")
    return rows.groupBy("term_id", "path").agg(F.count("*").alias("n"), F.max_by("web_id", order).alias("web_id"), F.max_by("tree_id", order).alias("tree_id"))


def term_tree(rows: DataFrame, branches: DataFrame) -> DataFrame:
    """The tree of :func:`mention_tree` from mentions (term_id) and branches, without building their facts.

    A mention lies on every branch of its term, so mentions are counted by term
    before branches are joined: what is shuffled is one partial count for each
    term and task.  Of branches with equal paths the last one gives the ids.
    """
    counts = rows.groupBy("term_id").agg(F.count("*").alias("k"))
    placed = branches.where(F.size("path_parts") > 0).withColumn("path", X.path_text("path_parts"))
    return counts.join(placed, "term_id").groupBy("term_id", "path").agg(F.sum("k").alias("n"), F.max_by("web_id", "branch_index").alias("web_id"), F.max_by("tree_id", "branch_index").alias("tree_id"))


def gene_classes(kind: str, links: DataFrame, paths: DataFrame | None = None, organism: str = "hsa") -> DataFrame:
    """(gene_id, class_id, path_parts, web_id, tree_id) of one classification.

    ``links`` maps genes to classes (``groups``: to path_parts themselves),
    ``paths`` classes to path_parts; a class without a path is left out.
    """
    if kind == "terms":
        p = paths.withColumnRenamed("term_id", "class_id")
        return links.join(p, "class_id").select("gene_id", "class_id", "path_parts", F.col("class_id").alias("web_id"), F.col("class_id").alias("tree_id"))
    if kind == "groups":
        text = X.path_text("path_parts")
        return links.select("gene_id", text.alias("class_id"), "path_parts", F.col("gene_id").alias("web_id"), text.alias("tree_id"))
    if kind == "pathways":
        return links.join(paths, "class_id").select("gene_id", "class_id", "path_parts", F.concat(F.lit(organism), "class_id").alias("web_id"), F.col("class_id").alias("tree_id"))
    if kind == "types":
        return links.where(X.first_filled("class_id") != "").select("gene_id", "class_id", F.array("class_id").alias("path_parts"), F.col("gene_id").alias("web_id"), F.col("class_id").alias("tree_id"))
    raise ValueError(f"unknown classification: {kind}")


def known_approaches(asked: str, known: tuple[str, ...] = ("groups", "pathways", "terms", "types")) -> list[str]:
    """A comma list, checked against what there is."""
    names = [x.strip() for x in asked.split(",") if x.strip()]
    if unknown := sorted(set(names) - set(known)):
        raise ValueError(f"unknown: {', '.join(unknown)}")
    return names


def gene_counts(genes: DataFrame) -> DataFrame:
    """(gene_id, k): how many documents mention a gene."""
    return genes.select("pmid", "gene_id").distinct().groupBy("gene_id").agg(F.count("*").alias("k"))


def gene_tree(genes: DataFrame, classes: DataFrame, counts: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The tree (gene_id, path, n, web_id, tree_id), n counting documents, and each document's leaf names (pmid, names).

    ``genes`` has pmid and gene_id.  Names are ordered by gene, class and path.
    Documents are counted by gene before classes are joined (``counts``, if at
    hand), so that a gene of many classes doesn't repeat its documents for the tree.
    """
    pairs, placed = genes.select("pmid", "gene_id").distinct(), classes.withColumn("path", X.path_text("path_parts"))
    order = F.struct("class_id", "web_id", "tree_id")
    tree = (gene_counts(genes) if counts is None else counts).join(placed, "gene_id").groupBy("gene_id", "path").agg(F.sum("k").alias("n"), F.max(order).alias("o")).select("gene_id", "path", "n", "o.web_id", "o.tree_id")
    rows = pairs.join(placed, "gene_id")
    name = F.element_at("path_parts", -1)
    seen = rows.groupBy("pmid", name.alias("name")).agg(F.min(F.struct("gene_id", "class_id", "path")).alias("o"))
    names = seen.groupBy("pmid").agg(F.sort_array(F.collect_list(F.struct("o", "name"))).alias("s")).select("pmid", F.col("s.name").alias("names"))
    return tree, names


def ordered_tree(tree: DataFrame, key: str) -> DataFrame:
    """By count, largest first, then key and path."""
    return tree.orderBy(F.desc("n"), key, "path")


def tree_entries(tree: DataFrame, key: str, shown: str) -> DataFrame:
    """The bundle's tree columns; counts are text."""
    return tree.select(F.col(key).alias(shown), "web_id", "tree_id", F.col("n").cast("string").alias("count(*)"), F.col("path").alias("first"))


def gene_documents(documents: DataFrame, genes: DataFrame, names: DataFrame) -> DataFrame:
    """Documents with at least one gene mention, and their subjects."""
    rows = documents.join(genes.select("pmid").distinct(), "pmid", "left_semi").join(names, "pmid", "left")
    subjects = X.subjects_text(F.coalesce("names", F.array().cast("array<string>")))
    plain = ("title_e", "journal", "doi", "year", "month", "day", "authors")
    return rows.select("pmid", *(X.first_filled(c).alias(c) for c in plain), subjects.alias("subjects"), subjects.alias("assigned_subjects1"), F.col("pmid").alias("file_name"))


def merge_counts(old: DataFrame, new: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Counts added up; ids of the old tree stay, new keys come in."""
    both = old.select(*keys, "n", "web_id", "tree_id", F.lit(0).alias("age")).unionByName(new.select(*keys, "n", "web_id", "tree_id", F.lit(1).alias("age")))
    return both.groupBy(*keys).agg(F.sum("n").alias("n"), F.min_by("web_id", "age").alias("web_id"), F.min_by("tree_id", "age").alias("tree_id"))


def split_tree(tree: DataFrame, documents: DataFrame, split_all: bool = False) -> tuple[DataFrame, DataFrame]:
    """The tree with its ``bucket``, and (bucket, document) for each bucket that one of a document's subjects is a leaf of."""
    bucketed = tree.withColumn("bucket", X.bucket("path", split_all))
    leaves = bucketed.select(X.leaf("path").alias("leaf"), "bucket").distinct()
    hits = documents.select("pmid", F.explode(F.array_distinct(X.subjects_list("subjects"))).alias("leaf")).join(leaves, "leaf").select("pmid", "bucket").distinct()
    return bucketed, documents.join(hits, "pmid")


def bucket_sizes(bucketed: DataFrame) -> DataFrame:
    """(bucket, slug, entries), largest first."""
    return bucketed.groupBy("bucket").agg(F.count("*").alias("entries")).withColumn("slug", X.slug("bucket")).orderBy(F.desc("entries"), "bucket")


def fill_blanks(documents: DataFrame, other: DataFrame, fields: tuple[str, ...] = ("cat", "hard_category", "format"), key: str = "pmid") -> DataFrame:
    """``documents`` with blank fields filled from ``other``; filled ones stay. ``filled_<field>`` says what was."""
    given = other.select(key, *(F.col(f).alias(f"__{f}") for f in fields))
    rows = documents.join(given, key, "left")
    for f in fields:
        rows = rows.withColumn(f"filled_{f}", (X.first_filled(f) == "") & (X.first_filled(f"__{f}") != "")).withColumn(f, X.first_filled(f, f"__{f}")).drop(f"__{f}")
    return rows


def fill_counts(filled: DataFrame, fields: tuple[str, ...] = ("cat", "hard_category", "format")) -> DataFrame:
    any_filled = F.greatest(*(F.col(f"filled_{f}") for f in fields)) if len(fields) > 1 else F.col(f"filled_{fields[0]}")
    return filled.agg(*(F.count_if(f"filled_{f}").alias(f) for f in fields), F.count_if(any_filled).alias("documents"))
