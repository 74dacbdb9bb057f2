"""Gene trees of many suppliers, and of genes with many documents and classes."""

from __future__ import annotations

import duckdb
from pyspark.sql import functions as F

from arborlit.operators import trees
from arborlit.plans import queries, whole


def test_suppliers_of_more_than_five_digits(spark, sf_small, tmp_path):
    """Numbers that agree in their first five digits are pathways of their own."""
    held = duckdb.connect()
    numbers = "10000 + {0} % 2 * 90000 + {0} % 10"
    for name in ("region", "nation", "supplier", "part", "orders", "lineitem"):
        keys = {"supplier": f"REPLACE (({numbers.format('s_suppkey')}) AS s_suppkey)", "lineitem": f"REPLACE (({numbers.format('l_suppkey')}) AS l_suppkey)"}.get(name, "")
        only = "WHERE s_suppkey < 10" if name == "supplier" else "WHERE l_orderkey < 300" if name == "lineitem" else ""
        held.sql(f"COPY (SELECT * {keys} FROM '{sf_small}/{name}.parquet' {only}) TO '{tmp_path}/{name}.parquet'")
        held.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    want = sorted(held.sql(f"SELECT approach, gene_id, web_id, tree_id, n, path FROM ({queries.ORACLES['gene_programs']})").fetchall())
    got = whole.gene_programs(spark, str(tmp_path)).select("approach", "gene_id", "web_id", "tree_id", "n", "path")
    assert sorted(tuple(r) for r in got.collect()) == want
    assert len({r[5] for r in want if r[0] == "pathways"}) == 10


def test_documents_are_counted_before_classes_are_joined(spark):
    genes = spark.createDataFrame([("1", "a"), ("1", "a"), ("2", "a"), (None, "a"), ("3", None), ("3", "b"), ("4", "none")], "pmid string, gene_id string")
    classes = spark.createDataFrame([("a", "x", ["T"], "wx", "tx"), ("a", "y", ["T"], "wy", "ty"), ("a", "z", ["T", "Z"], "wz", "tz"), ("b", "z", ["T", "Z"], "wz", "tz"), (None, "x", ["T"], "w", "t")], "gene_id string, class_id string, path_parts array<string>, web_id string, tree_id string")
    tree, names = trees.gene_tree(genes, classes)
    want = {("a", "T", 6, "wy", "ty"), ("a", "T.Z", 3, "wz", "tz"), ("b", "T.Z", 1, "wz", "tz")}
    assert {tuple(r) for r in tree.collect()} == want
    assert {tuple(r) for r in trees.gene_tree(genes, classes, trees.gene_counts(genes))[0].collect()} == want
    assert {r.pmid: r.names for r in names.where(F.col("pmid").isNotNull()).collect()} == {"1": ["T", "Z"], "2": ["T", "Z"], "3": ["Z"]}
    plan = tree._jdf.queryExecution().optimizedPlan().toString()
    assert "count(1)" in plan[plan.index("Join Inner") :]
