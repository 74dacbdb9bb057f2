"""Whole programs on small fixtures: fetching with resumption, citations, predictions, splitting, dry runs."""

from __future__ import annotations

import json

import pytest

from arborlit.operators import incremental
from arborlit.plans import programs
from arborlit.sources import readers
from arborlit.sources import schemas as S


def test_fetch_goes_on_where_it_broke(spark, tmp_path):
    def answer(ids):
        """A remote service that knows no id that ends in 9."""
        return json.dumps([{"pmid": x, "id": x, "date": f"2020-01-0{int(x) % 9 + 1}", "passages": [{"text": f"title {x}", "infons": {"type": "title"}}]} for x in ids if not x.endswith("9")])

    def broken(ids):
        if any(int(x) >= 20 for x in ids):
            raise RuntimeError("the line went dead")
        return answer(ids)

    cache, out, failed = (str(tmp_path / x) for x in ("cache.jsonl.gz", "docs.csv", "failed.txt"))
    search = spark.createDataFrame([(f"{k:02d}", f"t{k}", "j", k) for k in range(30)], "pmid string, title_e string, journal string, ord int")
    first = programs.fetch_documents(spark, search, cache, out, broken, failed, batch=5, every=2, tries=1).first()
    assert (first.ok, first.failed, first.total) == (18, 12, 30)
    assert {r.pmid for r in readers.cached_records(spark, cache).collect()} == {f"{k:02d}" for k in range(20) if k % 10 != 9}
    again = programs.fetch_documents(spark, search, cache, out, answer, failed, batch=5, every=2, tries=1).first()
    assert (again.ok, again.failed, again.total) == (27, 3, 30)
    assert sorted(r.pmid for r in readers.id_list(spark, failed).collect()) == ["09", "19", "29"]
    rows = {r.pmid: r for r in readers.table(spark, out).collect()}
    assert rows["07"].title_e == "title 07" and rows["07"].year == "2020" and rows["19"].failure_reason == "absent_from_response"
    retried = programs.fetch_documents(spark, search, cache, out, lambda ids: json.dumps([{"pmid": x, "id": x} for x in ids]), failed, ids=readers.id_list(spark, failed), batch=5, tries=1).first()
    assert (retried.ok, retried.failed) == (30, 0)  # rows that are not redone stay
    assert not readers.exists(spark, failed)


def test_citations_are_fetched_once(spark, tmp_path):
    docs = spark.createDataFrame([("1", "ok"), ("2", "ok"), ("3", "failed"), ("4", "ok")], "pmid string, fetch_status string")
    caches = {k: str(tmp_path / k) for k in ("metrics", "works", "sources")}
    fetch = {
        "metrics": lambda ids: {x: {"citation_count": int(x) * 10, "nih_percentile": 1.5} for x in ids if x != "4"},
        "works": lambda ids: {x: {"source_id": "S1"} for x in ids if x != "2"},
        "sources": lambda ids: {x: {"display_name": f"J {x}", "two_yr_mean_citedness": 2.5} for x in ids},
    }
    expected = {("1", 10, 1.5, "J S1", 2.5), ("2", 20, 1.5, None, None), ("4", None, None, "J S1", 2.5)}
    told = lambda df: {(r.pmid, r.citation_count, r.nih_percentile, r.openalex_journal_name, r.openalex_2yr_mean_citedness) for r in df.collect()}
    assert told(programs.enrich_citations(docs, caches, fetch)) == expected

    def never(ids):
        raise AssertionError(f"fetched again: {ids}")

    assert told(programs.enrich_citations(docs, caches, dict.fromkeys(fetch, never))) == expected


def test_predictions_join_the_documents(spark):
    rows = [(str(k), f"{'cat purrs softly' if k % 2 else 'dog barks loudly'} number{k % 5}", "", "", ("feline" if k % 2 else "canine") if k < 60 else "", "x" if k < 5 else "") for k in range(90)]
    docs = spark.createDataFrame([*rows, ("none", "", "", "", "", "")], "pmid string, title_e string, abstract string, subjects string, hard_category string, format string")
    out, reports = programs.predict_into(docs, iterations=50)
    got = {r.pmid: r for r in out.collect()}
    assert len(got) == 91 and set(reports) == {"hard_category"}
    assert all(got[str(k)].hard_category_predicted == ("feline" if k % 2 else "canine") and got[str(k)].hard_category_predicted_confidence > 0.5 for k in range(60, 90))
    assert all(got[x].hard_category_predicted == "" and got[x].hard_category_predicted_confidence is None for x in ("0", "59", "none"))
    assert {r.format_predicted for r in got.values()} == {""}
    some, _ = programs.predict_into(docs, ("hard_category",), limit=10, iterations=20)
    assert some.count() == 91 and some.where("hard_category_predicted <> ''").count() <= 10


def test_split_bundles(spark, tmp_path):
    tree = spark.createDataFrame([("D1", "Diseases.flu", 2, "D1", "C01"), ("D2", "Anatomy.arm", 1, "D2", "A01"), ("D3", "Organisms.cat", 1, "D3", "B01")], "mesh_id string, path string, n long, web_id string, tree_id string")
    blank = {c: "" for c in S.BUNDLE_COLUMNS}
    docs = spark.createDataFrame([{**blank, "pmid": p, "subjects": s} for p, s in (("1", "flu | "), ("2", "arm | flu | "), ("3", "nothing | "))])
    sizes = programs.split_bundles(tree, docs, str(tmp_path))
    assert {(r.bucket, r.slug, r.entries) for r in sizes.collect()} == {("Diseases", "diseases", 1), ("other", "other", 2)}
    read = lambda x: tuple({r[c] for r in df.collect()} for df, c in zip(readers.bundle(spark, str(tmp_path / x)), ("mesh_id", "pmid"), strict=True))
    assert read("diseases.json") == ({"D1"}, {"1", "2"})
    assert read("other.json") == ({"D2", "D3"}, {"2"})


def test_upkeep_report_writes_nothing(spark):
    docs = spark.createDataFrame([("1", "", 0), ("2", "", 1), ("3", "old | ", 2)], "pmid string, subjects string, ord int")
    tree = spark.createDataFrame([("D000001", "A.flu", 5, "D000001", "A1", 0)], "mesh_id string, path string, n long, web_id string, tree_id string, ord int")
    note = lambda i: {"id": "1", "text": "x", "infons": {"type": "Disease", "identifier": f"MESH:{i}"}}
    records = spark.createDataFrame([("1", {"passages": [{"annotations": [note("D000001"), note("D000009")]}]}), ("3", {"passages": [{"annotations": [note("D000001")]}]})], f"pmid string, record {S.RECORD}")
    none = spark.createDataFrame([], "term_id string, branch_index int, name string, path_parts array<string>, tree_id string, web_id string")
    row = programs.upkeep_report(docs, incremental.enrich_subjects(docs, tree, records, none)).first()
    assert tuple(row) == (1, 2, 1, 1)


@pytest.mark.parametrize("levels", [1, 6])
def test_lineages_do_not_depend_on_cuts(spark, monkeypatch, levels):
    from arborlit.operators import ontology

    monkeypatch.setattr(ontology, "LEVELS", levels)
    rows = [("r", "root", "", []), ("a", "A", "", ["r"]), ("b", "B", "", ["r", "gone"]), ("c", "C", "molecular_function", ["a", "b"]), ("x", "X", "", ["y"]), ("y", "Y", "", ["x", "c"])]
    terms = spark.createDataFrame(rows, "term_id string, name string, namespace string, parents array<string>")
    got = {}
    for r in ontology.dag_lineages(terms).orderBy("path_no").collect():
        got.setdefault(r.term_id, []).append(".".join(r.path_parts))
    assert got["c"] == ["Molecular Function.root.A.C", "Molecular Function.root.B.C"]
    assert got["x"] == ["Gene Ontology.root.A.C.Y.X", "Gene Ontology.root.B.C.Y.X"]
    assert got["y"] == ["Gene Ontology.X.Y", "Gene Ontology.root.A.C.Y", "Gene Ontology.root.B.C.Y"]
    assert ontology.dag_lineages(terms, max_depth=2).where("term_id = 'x'").first().path_parts == ["Gene Ontology", "C", "Y", "X"]
