"""Roll-ups of ragged hierarchies: distinct documents and genes under every node, top children and the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arborlit.functions import text as X
from arborlit.operators import intervals
from arborlit.sources.durable import durable


def leaf_paths(tree: DataFrame, first_only: bool = False) -> DataFrame:
    """(leaf, path): all paths that end in a leaf name; ``first_only``: the first by ``ord``."""
    rows = tree.where(X.first_filled("path") != "").withColumn("leaf", X.leaf("path"))
    if first_only:
        return rows.groupBy("leaf").agg(F.min_by("path", "ord").alias("path"))
    return rows.select("leaf", "path").distinct()


def nodes_of(path: Column | str) -> Column:
    """All prefixes of a dotted path, the path itself among them."""
    return F.transform(X.prefixes(F.split(X.col(path), r"\.")), lambda p: F.array_join(p, "."))


def expanded(rows: DataFrame) -> DataFrame:
    """``rows`` (path, ...) once for each node of their paths, that node as ``path``.

    Prefixes are made once for each distinct path and joined, not once a row.
    """
    paths = rows.select("path").distinct().select("path", F.explode(nodes_of("path")).alias("node"))
    return rows.join(paths, "path").drop("path").withColumnRenamed("node", "path")


def document_nodes(documents: DataFrame, tree: DataFrame, first_only: bool = False) -> DataFrame:
    """Distinct (path, pmid): the documents of each node, through the leaves that their subjects name."""
    leaves = documents.select("pmid", F.explode(F.array_distinct(X.subjects_list("subjects"))).alias("leaf"))
    paths = leaf_paths(tree, first_only).withColumn("path", F.explode(nodes_of("path"))).distinct()
    return leaves.join(paths, "leaf").select("path", "pmid").distinct()


def document_places(documents: DataFrame, tree: DataFrame, held: DataFrame, first_only: bool = False) -> DataFrame:
    """Distinct (low, pmid): the numbers of the leaves that documents' subjects name; nothing is repeated for the nodes above."""
    leaves = documents.select("pmid", F.explode(F.array_distinct(X.subjects_list("subjects"))).alias("leaf"))
    return intervals.placed(leaves.join(leaf_paths(tree, first_only), "leaf").select("path", "pmid"), held).distinct()


def hierarchy(tree: DataFrame, nodes: DataFrame, gene: str = "gene_id", held: DataFrame | None = None) -> DataFrame:
    """(path, parent_path, depth, name, documents, genes) for each node of the tree.

    ``nodes`` has (path, pmid), of each document the paths that it lies at; paths
    above them may be there too, and change nothing.  Counts are of distinct ids,
    by sums that add up along the hierarchy (:func:`intervals.distinct_below`).
    The root isn't a row; its children have a blank parent.  ``held``: labels of a
    hierarchy that has at least the tree's paths, say those of its vocabulary.
    """
    rows = tree.where(X.first_filled("path") != "").select("path", F.col(gene).alias("g"))
    held = durable(intervals.labels(rows)) if held is None else held
    genes, documents = intervals.distinct_below(rows, "g", held), intervals.distinct_below(nodes, "pmid", held)
    counted = genes.withColumnRenamed("n", "genes").join(documents.withColumnRenamed("n", "documents"), "path", "left")
    return with_place(counted.na.fill(0, ["documents"]))


def with_place(rows: DataFrame) -> DataFrame:
    parts = F.split("path", r"\.")
    parent = F.array_join(F.slice(parts, 1, F.size(parts) - 1), ".")
    return rows.select("path", parent.alias("parent_path"), F.size(parts).alias("depth"), X.leaf("path").alias("name"), "documents", "genes")


def leaf_nodes(nodes: DataFrame) -> DataFrame:
    """Nodes without children."""
    return nodes.join(nodes.select(F.col("parent_path").alias("path")).distinct(), "path", "left_anti")


def composition(nodes: DataFrame, n: int | None = None) -> DataFrame:
    """(name, documents) of the top level, most documents first."""
    top = nodes.where("depth = 1").select("name", "documents").orderBy(F.desc("documents"), "name")
    return top.limit(n) if n else top


def top_leaves(nodes: DataFrame, n: int = 12) -> DataFrame:
    """The leaf nodes of most documents."""
    return leaf_nodes(nodes).select("path", "name", "documents").orderBy(F.desc("documents"), "path").limit(n)


def top_associations(tree: DataFrame, gene: str = "gene_id", n: int = 12) -> DataFrame:
    """(gene, leaf, documents): the largest entries of the tree, one of each gene and leaf."""
    best = tree.where(X.first_filled("path") != "").groupBy(F.col(gene).alias("gene"), X.leaf("path").alias("leaf")).agg(F.max("n").alias("documents"))
    return best.orderBy(F.desc("documents"), "gene", "leaf").limit(n)


def node_genes(tree: DataFrame, gene: str = "gene_id") -> DataFrame:
    """Distinct (path, gene) for each node."""
    return expanded(tree.where(X.first_filled("path") != "").select("path", F.col(gene).alias("gene")).distinct()).distinct()


def cut_genes(cut: DataFrame, genes: DataFrame) -> DataFrame:
    """(parent_path, genes): the distinct genes of ``genes`` (path, gene) at or below the ``cut`` nodes of each parent."""
    paths = genes.select("path").distinct().select("path", F.explode(nodes_of("path")).alias("node"))
    parents = paths.join(cut.select(F.col("path").alias("node"), "parent_path"), "node").select("path", "parent_path").distinct()
    return genes.join(parents, "path").groupBy("parent_path").agg(F.count_distinct("gene").alias("genes"))


def prune(nodes: DataFrame, genes: DataFrame, top: int, depth: int | None = None, focus: str = "", label: str = "more") -> DataFrame:
    """The children kept for each node below ``focus``, and a row for those left out.

    Of each node's children the ``top`` with most documents stay (ties: by path),
    to ``depth`` levels; the rest is one row with path null, how many they are,
    their most documents (a lower bound) and their distinct genes.
    Returns (parent_path, rank, path, name, documents, genes).
    """
    base = len(focus.split(".")) if focus else 0
    below = nodes.where(F.col("parent_path").startswith(focus + ".") | (F.col("parent_path") == focus)) if focus else nodes
    if depth is not None:
        below = below.where(F.col("depth") <= base + depth)
    ranked = below.withColumn("rank", F.row_number().over(W.partitionBy("parent_path").orderBy(F.desc("documents"), "path")))
    # a node shows only if all above it do
    shown = ranked.where(F.col("rank") <= top)
    cut = ranked.where(F.col("rank") > top)
    hidden = cut.select(F.col("path").alias("h"))
    above = ranked.select("path", F.explode(nodes_of("parent_path")).alias("h")).join(hidden, "h", "left_semi").select("path").distinct()
    shown = shown.join(above, "path", "left_anti")
    cut = cut.join(above, "path", "left_anti")
    gathered = cut_genes(cut, genes)
    rest = cut.groupBy("parent_path").agg(F.count("*").alias("k"), F.max("documents").alias("documents")).join(gathered, "parent_path", "left")
    rest = rest.select("parent_path", F.lit(top + 1).alias("rank"), F.lit(None).cast("string").alias("path"), F.concat_ws(" ", F.col("k").cast("string"), F.lit(label)).alias("name"), "documents", F.coalesce("genes", F.lit(0).cast("long")).alias("genes"))
    return shown.select("parent_path", "rank", "path", "name", "documents", "genes").unionByName(rest)


def layout_sums(pruned: DataFrame) -> DataFrame:
    """(path, width): the documents of the leaves shown below each node, added up (for drawing only)."""
    kept = pruned.where("path is not null")
    leaf = pruned.join(kept.select(F.col("parent_path").alias("path")).distinct(), "path", "left_anti")
    place = F.coalesce("path", "parent_path")
    return leaf.select(F.explode(nodes_of(place)).alias("path"), "documents").where("path <> ''").groupBy("path").agg(F.sum("documents").alias("width"))


def most_documents(nodes: DataFrame) -> DataFrame:
    return nodes.agg(F.max("documents").alias("documents"))


def documents_of(documents: DataFrame, nodes: DataFrame, path: str, limit: int = 300, held: DataFrame | None = None) -> DataFrame:
    """The documents under a node (blank: all), newest first: pmid, title, journal, date and link.

    ``nodes`` has (path, pmid) for every node; or, with the labels ``held``, (low,
    pmid) for the places of documents only, of which a range is read.
    """
    chosen = nodes.where(F.col("path") == path) if held is None else intervals.below(nodes, held, path)
    rows = documents if path == "" else documents.join(chosen.select("pmid"), "pmid", "left_semi")
    shown = rows.select("pmid", X.title_or_default("title_e").alias("title"), X.journal_head("journal").alias("journal"), X.shown_date(F.col("year"), F.col("month"), F.col("day")).alias("date"), X.document_url("pmid").alias("url"))
    return shown.orderBy(F.desc("date"), "pmid").limit(limit)


def summary(documents: DataFrame, tree: DataFrame, gene: str = "gene_id") -> DataFrame:
    """(documents, genes, categories): distinct ids, genes and leaf names."""
    filled = tree.where(X.first_filled("path") != "").agg(F.count_distinct(gene).alias("genes"), F.count_distinct(X.leaf("path")).alias("categories"))
    return documents.agg(F.count_distinct("pmid").alias("documents")).crossJoin(filled)  # one row each
