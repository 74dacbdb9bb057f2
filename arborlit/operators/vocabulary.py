"""Where a vocabulary's terms lie in its hierarchy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arborlit.functions import text as X

EMPTY = "array<string>"


def tree_numbers(descriptors: DataFrame) -> DataFrame:
    """(tree_number, name, dui, place) for each place of each descriptor."""
    return descriptors.select("dui", "name", F.posexplode("tree_numbers").alias("place", "tree_number"))


def lineages(descriptors: DataFrame) -> DataFrame:
    """(tree_number, dui, place, path_parts): the names of all prefixes of a tree number, led by its category.

    Every prefix is generated and looked up by an equi-join; unknown prefixes are
    skipped, and a name that repeats the one before it is dropped.
    """
    numbers = tree_numbers(descriptors)
    names = numbers.groupBy("tree_number").agg(F.max_by("name", "dui").alias("prefix_name"))
    steps = numbers.select("tree_number", "dui", "place", F.posexplode(X.prefixes(F.split("tree_number", r"\."))).alias("depth", "p"))
    steps = steps.withColumn("prefix", F.array_join("p", "."))
    named = steps.join(names.withColumnRenamed("tree_number", "prefix"), "prefix", "left")
    found = named.groupBy("tree_number", "dui", "place").agg(F.sort_array(F.collect_list(F.when(F.col("prefix_name").isNotNull(), F.struct("depth", "prefix_name")))).alias("s"))
    top = X.top_level_name("tree_number")
    parts = F.concat(F.when(top.isNotNull(), F.array(top)).otherwise(F.array().cast(EMPTY)), F.col("s.prefix_name"))
    return found.select("tree_number", "dui", "place", X.drop_repeats(parts).alias("path_parts"))


def term_branches(descriptors: DataFrame, supplements: DataFrame | None = None) -> DataFrame:
    """(term_id, branch_index, name, path_parts, tree_id, web_id): every place of every term.

    A supplementary term borrows the places of the descriptors it is mapped to and
    keeps its own name.  A term without a place has one branch with a blank path.
    """
    paths = lineages(descriptors).where(F.size("path_parts") > 0)
    own = descriptors.select("dui", "name").join(paths, "dui", "left").select(F.col("dui").alias("term_id"), F.lit(0).alias("via"), F.col("place"), "name", "path_parts", F.col("tree_number").alias("tree_id"), F.col("dui").alias("web_id"))
    if supplements is not None:
        mapped = supplements.select("scr", "name", F.posexplode_outer("mapped_dui").alias("via", "dui")).join(paths, "dui", "left")
        borrowed = mapped.select(F.col("scr").alias("term_id"), "via", "place", "name", "path_parts", F.col("tree_number").alias("tree_id"), F.when(F.col("place").isNotNull(), F.col("dui")).alias("web_id"))
        own = own.unionByName(borrowed.join(descriptors.select(F.col("dui").alias("term_id")), "term_id", "left_anti"))
    # a term that has places doesn't need the placeholders of what it is mapped to
    placed = W.partitionBy("term_id")
    own = own.withColumn("has", F.max(F.col("place").isNotNull()).over(placed))
    own = own.where(F.col("place").isNotNull() | ~F.col("has"))
    order = placed.orderBy(F.col("via").asc_nulls_last(), F.col("place").asc_nulls_last())
    own = own.withColumn("branch_index", F.row_number().over(order) - 1).where("place is not null or branch_index = 0")
    return own.select("term_id", "branch_index", "name", F.coalesce("path_parts", F.array().cast(EMPTY)).alias("path_parts"), F.coalesce("tree_id", F.lit("")).alias("tree_id"), F.coalesce("web_id", F.lit("")).alias("web_id"))


def branches_of_tree(tree: DataFrame, key: str = "mesh_id") -> DataFrame:
    """Branches recovered from a tree (key, path, web_id, tree_id, ord): the name is the path's leaf."""
    rows = tree.where((X.first_filled(key) != "") & (X.first_filled("path") != ""))
    index = F.row_number().over(W.partitionBy(key).orderBy("ord")) - 1
    return rows.select(F.col(key).alias("term_id"), index.alias("branch_index"), X.leaf("path").alias("name"), F.split("path", r"\.").alias("path_parts"), "tree_id", "web_id")
