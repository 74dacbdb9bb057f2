"""Bundles that no task holds whole."""

from __future__ import annotations

import json

import pytest

from arborlit.plans import files, programs, whole
from arborlit.sources import readers, sinks


@pytest.fixture
def ungathered(monkeypatch):
    def gathered(*_, **__):
        raise AssertionError("a bundle in one row")

    monkeypatch.setattr(sinks, "bundle_row", gathered)


@pytest.mark.parametrize("query", [files.bundle_tree, files.bundle_docs, files.approach_trees, files.result_tables, files.bundle_arrays, whole.split_program])
def test_queries_gather_no_bundle(spark, ungathered, sf_small, query):
    assert query(spark, sf_small).count() > 0


def test_arrays_lie_beside_their_documents(spark, tmp_path):
    """A file has what the parallel arrays say of its documents; a tree's entries go before."""
    tree = spark.createDataFrame([("D1", "w", "t", "5", "b"), ("D2", "w", "t", "12", "a")], "mesh_id string, web_id string, tree_id string, `count(*)` string, first string")
    docs = spark.createDataFrame([(f"{k:03}", f"f{k}", None if k % 2 else "x") for k in range(100)], "pmid string, factor string, cat string")
    sinks.write_bundle_parts(tree, docs, str(tmp_path / "p"), merged=True, files=5)
    parts = [json.loads(p.read_text()) for p in sorted((tmp_path / "p").glob("part-*")) if p.stat().st_size]
    held = [p for p in parts if "docs" in p]
    assert len(held) > 1
    for p in held:
        assert [{"factor": d["factor"]} for d in p["docs"]] == p["factors"] and [{"cat": d["cat"]} for d in p["docs"]] == p["categories"]
    assert [d["pmid"] for p in held for d in p["docs"]] == [f"{k:03}" for k in range(100)]
    assert [t["mesh_id"] for p in parts for t in p.get("tree", [])] == ["D2", "D1"]


def test_split_bundles_are_folders(spark, tmp_path, ungathered):
    tree = spark.createDataFrame([("D1", "Diseases.flu", 2, "D1", "C01")], "mesh_id string, path string, n long, web_id string, tree_id string")
    docs = spark.createDataFrame([(f"{k}", "flu | ") for k in range(50)], "pmid string, subjects string")
    programs.split_bundles(tree, docs, str(tmp_path))
    assert len([p for p in (tmp_path / "diseases.json").glob("part-*") if p.stat().st_size]) > 1
    assert readers.bundle(spark, str(tmp_path / "diseases.json"))[1].select("pmid").distinct().count() == 50
