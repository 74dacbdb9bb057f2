"""Readers and writers on small files."""

from __future__ import annotations

import gzip
import json

import pytest

from arborlit.operators import documents, mentions
from arborlit.sources import readers as R
from arborlit.sources import remote, sinks

RECORD = {
    "id": "1",
    "pmid": "1",
    "pmcid": "PMC1",
    "date": "2021-03-05T00:00:00Z",
    "year": 2021,
    "journal": "J",
    "authors": ["A", "B"],
    "passages": [
        {"infons": {"type": "title", "journal": "J; 2020 Mar 5. doi: 10.1/x"}, "text": "T", "annotations": [{"id": "7", "text": "flu", "infons": {"identifier": "MESH:D000001", "type": "Disease"}}, {"id": "8", "text": "g", "infons": {"Identifier": "Gene:672;675", "Type": "Gene"}}]},
        {"infons": {"type": "abstract"}, "text": "B", "annotations": []},
    ],
}


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_search_results(spark, tmp_path):
    path = write(tmp_path / "s.tsv", '# c\n\npmid\ttitle_e\tjournal\n1\tsay "hi"\tJ\n2\t\tK\n# 3\tx\ty\n')
    rows = R.search_results(spark, path).orderBy("ord").collect()
    assert [(r.pmid, r.title_e, r.journal) for r in rows] == [("1", 'say "hi"', "J"), ("2", "", "K"), ("# 3", "x", "y")]
    assert R.search_results(spark, write(tmp_path / "s.csv", "pmid,journal\n5,J\n")).first().pmid == "5"
    with pytest.raises(ValueError, match="pmid"):
        R.search_results(spark, write(tmp_path / "t.tsv", "id\n1\n"))


def test_previous_dates(spark, tmp_path):
    path = write(tmp_path / "d.csv", "pmid,year,month,day,date\n1,2021.0,3,,\n1,2022,4,9,\n2,,,,\n3,nan,,,20200101\nnan,2020,,,\n")
    got = {r.pmid: tuple(r.dates) for r in R.previous_dates(spark, path).collect()}
    assert got == {"1": ("2022-04-09", "2022", "04", "09"), "3": ("20200101", "", "", "")}
    assert R.previous_dates(spark, str(tmp_path / "none.csv")).count() == 0


def cache(tmp_path):
    path = tmp_path / "c.jsonl.gz"
    lines = [{"pmid": "1", "record": {**RECORD, "journal": "old"}}, None, {"pmid": "2", "record": None}, {"pmid": "1", "record": RECORD}]
    with open(path, "wb") as out:
        for x in lines:
            out.write(gzip.compress((json.dumps(x) if x else "{bad").encode() + b"\n"))
    return str(path)


def test_caches(spark, tmp_path):
    got = R.cached_records(spark, cache(tmp_path)).collect()
    assert [(r.pmid, r.record.journal) for r in got] == [("1", "J")]
    older = write(tmp_path / "c.jsonl", json.dumps({"pmid": "1", "record": {"journal": "legacy"}}))
    assert R.cached_records(spark, cache(tmp_path), older).first().record.journal == "legacy"
    good = write(tmp_path / "g.jsonl", "\n".join(json.dumps({"pmid": p, "record": RECORD}) for p in "112"))
    assert R.all_records(spark, good).count() == 3
    with pytest.raises(Exception, match="(?i)malformed"):
        R.all_records(spark, write(tmp_path / "b.jsonl", "{bad\n")).collect()
    kv = write(tmp_path / "k.jsonl", '{"key":"a","value":{"n":1}}\n{"key":"a","value":null}\n{"key":"b","value":{}}\n')
    assert {r.key: r.value and r.value.n for r in R.key_values(spark, kv, "STRUCT<n: INT>").collect()} == {"a": None, "b": None}


def test_vocabulary_files(spark, tmp_path):
    xml = "<Set><DescriptorRecord><DescriptorUI>D1</DescriptorUI><DescriptorName><String>One</String></DescriptorName><TreeNumberList><TreeNumber>C01</TreeNumber><TreeNumber>C02</TreeNumber></TreeNumberList></DescriptorRecord><DescriptorRecord><DescriptorUI>D2</DescriptorUI></DescriptorRecord><DescriptorRecord><DescriptorUI>D3</DescriptorUI><DescriptorName><String>Three</String></DescriptorName></DescriptorRecord></Set>"
    (tmp_path / "d.xml.gz").write_bytes(gzip.compress(xml.encode()))
    assert sorted((r.dui, r.name, r.tree_numbers) for r in R.descriptors(spark, str(tmp_path / "d.xml.gz")).collect()) == [("D1", "One", ["C01", "C02"]), ("D3", "Three", [])]
    xml = "<Set><SupplementalRecord><SupplementalRecordUI>C9</SupplementalRecordUI><SupplementalRecordName><String>Nine</String></SupplementalRecordName><HeadingMappedToList><HeadingMappedTo><DescriptorReferredTo><DescriptorUI>D1</DescriptorUI></DescriptorReferredTo></HeadingMappedTo></HeadingMappedToList></SupplementalRecord></Set>"
    (tmp_path / "s.xml.gz").write_bytes(gzip.compress(xml.encode()))
    assert [tuple(r) for r in R.supplements(spark, str(tmp_path / "s.xml.gz")).collect()] == [("C9", "Nine", ["D1"])]


def test_ontology_file(spark, tmp_path):
    path = write(tmp_path / "g.obo", "format: 1\n\n[Term]\nid: A\nname: root\nnamespace: biological_process\n\n[Term]\nid: B\nname: b\nnamespace: x\nis_a: A ! root\nis_a: Z\n\n[Term]\nid: O\nis_obsolete: true\n\n[Typedef]\nid: T\n\n[Term]\nid: C\nis_a: B\n")
    got = {r.term_id: (r.name, r.namespace, r.parents) for r in R.ontology(spark, path).collect()}
    assert got == {"A": ("root", "biological_process", []), "B": ("b", "x", ["A", "Z"]), "C": ("C", "", ["B"])}


def test_gene_files(spark, tmp_path):
    (tmp_path / "g2g.gz").write_bytes(gzip.compress(b"#tax_id\tGeneID\tGO_ID\n9606\t1\tA\n9606\t1\tA\n10090\t2\tB\nbad\n"))
    assert [tuple(r) for r in R.gene_terms(spark, str(tmp_path / "g2g.gz")).collect()] == [("1", "A")]
    path = write(tmp_path / "h.tsv", 'entrez_id\tlocus_group\tgene_group\n1\tprotein\ta | "b"|\n2\t\t\n\tx\ty\n')
    assert sorted((r.gene_id, r.path_parts) for r in R.gene_groups(spark, path).collect()) == [("1", ["protein", '"b"']), ("1", ["protein", "a"]), ("2", ["Unclassified"])]
    path = write(tmp_path / "o.txt", "+C\nA<b>Top</b>\nB\nB  Sub\nC    00010  Name [PATH:x]\nD x\nA<b>Other</b>\nC    00020  Bare\nCnot\n")
    assert {r.class_id: r.path_parts for r in R.pathway_outline(spark, path).collect()} == {"00010": ["Top", "Sub", "Name"], "00020": ["Other", "Bare"]}
    path = write(tmp_path / "l.txt", "hsa:672\tpath:hsa04110\nhsa:672\tpath:hsa04110\nx\n")
    assert [tuple(r) for r in R.gene_links(spark, path).collect()] == [("672", "04110")]
    path = write(tmp_path / "i.tsv", "#tax_id\tGeneID\ttype_of_gene\n9606\t1\ta\n9606\t1\tb\n1\t2\tc\n")
    assert [tuple(r) for r in R.gene_types(spark, path).collect()] == [("1", "b")]


def test_documents_from_files(spark, tmp_path):
    search = R.search_results(spark, write(tmp_path / "s.tsv", "pmid\ttitle_e\tjournal\n1\tS1\tJ1\n3\tS3\tJ3\n3\tS3b\tJ3b\n4\t\t\n"))
    docs = documents.build_documents(search, R.cached_records(spark, cache(tmp_path)))
    rows = {r.pmid: r for r in docs.collect()}
    one = rows["1"]
    assert (one.title_e, one.abstract, one.journal, one.doi, one.authors, one.date, one.pmcid, one.source, one.fetch_status) == ("T", "B", "J; 2020 Mar 5. doi: 10.1/x", "10.1/x", "A; B", "20210305", "PMC1", "cache", "ok")
    assert (rows["3"].title_e, rows["3"].journal, rows["3"].failure_reason, rows["3"].failed) == ("S3b", "J3b", "absent_from_response", "1")
    assert len(rows) == 3
    sinks.write_documents(docs, str(tmp_path / "docs"))
    assert R.ok_documents(spark, str(tmp_path / "docs")).count() == 1
    previous = R.existing_output(spark, str(tmp_path / "docs"))
    again = documents.build_documents(search, R.cached_records(spark, cache(tmp_path)), previous=previous)
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in docs.select(again.columns).collect()}
    assert sinks.write_failed(docs, str(tmp_path / "failed.txt"), "x") == 2
    assert {r.pmid for r in R.id_list(spark, str(tmp_path / "failed.txt")).collect()} == {"3", "4"} == {r.pmid for r in R.id_list(spark, str(tmp_path / "failed_x.txt")).collect()}
    assert sinks.write_failed(docs.where("pmid = '1'"), str(tmp_path / "failed.txt")) == 0 and not (tmp_path / "failed.txt").exists()


def test_fetching(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()

    def fetch(ids):
        first = not (calls / "-".join(ids)).exists()
        (calls / "-".join(ids)).touch()
        if "9" in ids:
            raise remote.FetchError.http(404)
        if first:
            raise remote.FetchError.http(503)
        return json.dumps({"PubTator3": [{"pmid": x, "journal": f"J{x}"} for x in ids if x != "3"]})

    ids = spark.createDataFrame([(x,) for x in "123"], "pmid string")
    got = {r.pmid: (r.record and r.record.journal, r.reason) for r in remote.fetch_records(ids, fetch, batch=5, base=0.0).collect()}
    assert got == {"1": ("J1", ""), "2": ("J2", ""), "3": (None, "absent_from_response")}
    assert remote.attempt(fetch, ["9"], base=0.0) == ([], "http_404")
    assert remote.attempt(lambda _: "", ["1"], base=0.0) == ([], "no_record")
    assert remote.attempt(lambda _: "{", ["1"], base=0.0) == ([], "parse_error")
    assert remote.attempt(lambda _: json.dumps([{"pmid": "1"}]), ["1"])[0] == [{"pmid": "1"}]
    values = remote.fetch_values(ids.toDF("key"), lambda part: {"1": {"n": 4}}, "STRUCT<n: INT>")
    assert {r.key: r.value and r.value.n for r in values.collect()} == {"1": 4, "2": None, "3": None}


def test_response_shapes(spark):
    one = json.dumps({"pmid": "1"})
    raws = [f'{{"PubTator3": [{one}, {one}]}}', f"[{one}]", one, '{"PubTator3": null}']
    rows = spark.createDataFrame([(k, r) for k, r in enumerate(raws)], "k int, raw string")
    from pyspark.sql import functions as F

    assert [r.n for r in rows.select("k", F.size(R.response_records(F.col("raw"))).alias("n")).orderBy("k").collect()] == [2, 1, 1, 0]


def test_bundles(spark, tmp_path):
    tree = spark.createDataFrame([("D1", "w", "t", "5", "Diseases.x"), ("D2", "w", "t", "12", "Anatomy.y")], "mesh_id string, web_id string, tree_id string, `count(*)` string, first string")
    docs = spark.createDataFrame([("2", "x | ", "c2", "h", "f"), ("1", "y | ", "c1", "", "")], "pmid string, subjects string, cat string, hard_category string, format string")
    sinks.write_bundle(tree, docs, str(tmp_path / "b"), merged=True)
    data = json.loads(next((tmp_path / "b").glob("part-*")).read_text())
    assert [t["mesh_id"] for t in data["tree"]] == ["D2", "D1"] and [d["pmid"] for d in data["docs"]] == ["1", "2"]
    assert data["categories"] == [{"cat": "c1"}, {"cat": "c2"}] and data["formats"] == [{"format": ""}, {"format": "f"}]
    t, d = R.bundle(spark, str(tmp_path / "b"))
    assert [(r.mesh_id, r["count"], r.path) for r in t.orderBy("ord").collect()] == [("D2", "12", "Anatomy.y"), ("D1", "5", "Diseases.x")]
    found = R.matching_docs(d, spark.createDataFrame([("1",), ("9",)], "pmid string"))
    assert [tuple(r) for r in found.collect()] == [("1", "c1", "", "")]
    assert R.result_table(spark, str(tmp_path / "b"), "json-docs").count() == 2
    trees, both = R.approaches(spark, {"a": str(tmp_path / "b"), "b": str(tmp_path / "b")})
    assert trees.count() == 4 and {r.approach for r in both.collect()} == {"a", "b"}


def test_facts_caches_and_manifests(spark, tmp_path):
    records = R.cached_records(spark, cache(tmp_path))
    rows = mentions.mentions(records)
    assert sorted((r.kind, r.term_id) for r in rows.collect()) == [("Disease", "D000001"), ("Gene", "672;675")]
    none = spark.createDataFrame([], "term_id string, branch_index int, name string, path_parts array<string>, tree_id string, web_id string")
    facts = mentions.fact_table(mentions.facts(rows, none))
    sinks.write_facts(facts, str(tmp_path / "f"))
    sinks.write_facts(facts, str(tmp_path / "f"), append=True)
    assert R.table(spark, str(tmp_path / "f")).count() == 4
    sinks.append_cache(records, str(tmp_path / "cache"))
    sinks.append_cache(records, str(tmp_path / "cache"))
    assert R.cached_records(spark, str(tmp_path / "cache")).count() == 1
    (tmp_path / "src").mkdir()
    write(tmp_path / "src" / "a.txt", "hello")
    got = sinks.sync(spark, str(tmp_path / "src"), str(tmp_path / "dst"))
    assert [(r.file, r.size_bytes) for r in got.collect()] == [("a.txt", "5")]


def test_split_sink(spark, tmp_path):
    from arborlit.operators import trees

    tree = spark.createDataFrame([("a", "Diseases.x", 3), ("b", "Anatomy.y", 1)], "mesh_id string, path string, n long")
    docs = spark.createDataFrame([("1", "x | "), ("2", "y | x | ")], "pmid string, subjects string")
    sinks.write_split(*trees.split_tree(tree, docs), str(tmp_path / "s"))
    assert {(r.slug, r.mesh_id) for r in spark.read.parquet(str(tmp_path / "s" / "tree")).collect()} == {("diseases", "a"), ("other", "b")}
    assert {(r.slug, r.pmid) for r in spark.read.parquet(str(tmp_path / "s" / "docs")).collect()} == {("diseases", "1"), ("diseases", "2"), ("other", "2")}


def test_retry_of_listed_ids_keeps_the_rest(spark, tmp_path):
    search = R.search_results(spark, write(tmp_path / "s.tsv", "pmid\ttitle_e\n1\ta\n3\tb\n4\tc\n"))
    none = R.cached_records(spark, str(tmp_path / "missing"))
    before = documents.build_documents(search, none)
    fetched = spark.createDataFrame([("3", json.dumps({"id": "3", "year": "2020.0"}), ""), ("4", None, "http_500")], "pmid string, raw string, reason string")
    from pyspark.sql import functions as F

    from arborlit.sources import schemas as S

    fetched = fetched.select("pmid", F.from_json("raw", S.RECORD).alias("record"), "reason")
    after = documents.build_documents(search, none, fetched, previous=before, ids=spark.createDataFrame([("3",), ("4",)], "pmid string"))
    got = {r.pmid: (r.fetch_status, r.source, r.failure_reason, r.year, r.title_e) for r in after.collect()}
    assert got == {"1": ("failed", "search", "absent_from_response", "", "a"), "3": ("ok", "fetched", "", "2020", "b"), "4": ("failed", "search", "http_500", "", "c")}
    assert documents.build_documents(search, none, limit=2).count() == 2
    assert {r.source for r in documents.build_documents(search, none, fetched, previous=after, force=True).collect()} == {"search", "fetched"}
