"""The source that reads one large JSON array by byte ranges."""

from __future__ import annotations

import json
import random
import re

import pytest

from arborlit.sources import json_array, readers

TEXTS = ['plain', 'say "x"', "},{", '},{"', '}, {"pmid": "7"', '}],"docs":[{"pmid":"9"', "back\\slash\\", '\\"},{\\"pmid', "\n\t\r", "été \U0001f600", "", "}]}", '"docs": [{', "]", "{[", " " * 50]


def made(n, seed=0):
    rng = random.Random(seed)
    docs = [{"pmid": str(k), "title_e": rng.choice(TEXTS) + rng.choice(TEXTS), "cat": rng.choice([None, "c", '},{"'])} for k in range(n)]
    tree = [{"mesh_id": f"D{k}", "web_id": rng.choice(TEXTS), "tree_id": "C01", "count(*)": k, "first": rng.choice(TEXTS)} for k in range(max(1, n // 3))]
    for d in docs[::3]:
        del d["cat"]
    return {"tree": tree, "docs": docs, "factors": [{"factor": '}],"docs":[{'}] * n, "citations": []}


@pytest.mark.parametrize("indent", [None, 2, "compact"])
@pytest.mark.parametrize("split", [1, 17, 301, 5000, 1 << 20])
def test_ranges_give_every_record_once(tmp_path, indent, split):
    """Whatever the ranges, the records are those of a whole parse."""
    for n in (1, 2, 60) if split > 1 else (1, 4):
        value = made(n, split)
        for ascii_only in (True, False):
            style = {"separators": (",", ":")} if indent == "compact" else {"indent": indent}
            data = json.dumps(value, ensure_ascii=ascii_only, **style).encode()
            path = tmp_path / "b.json"
            path.write_bytes(data)
            for field in ("tree", "docs", "factors"):
                found = list(json_array.marks(data, True, field))
                begin = min(at for kind, _, at in found if kind == "begin")
                end = min(at for kind, _, at in found if kind == "end" and at > begin)
                got = [x for low in range(begin, end, split) for x in json_array.records(str(path), begin, end, low, min(end, low + split))]
                assert [json.loads(x) for _, x in got] == value[field]
                assert [at for at, _ in got] == sorted({at for at, _ in got})


@pytest.fixture
def file(tmp_path):
    path = tmp_path / "bundle.json"
    path.write_text(json.dumps(made(500), ensure_ascii=False))
    return str(path)


def test_bundle_in_many_tasks(spark, file, monkeypatch):
    tree, docs = readers.bundle(spark, file, split=2000)
    assert docs.rdd.getNumPartitions() > 10
    value = made(500)
    rows = docs.orderBy("ord").collect()
    assert [(r.pmid, r.title_e, r.cat, r.factor) for r in rows] == [(d["pmid"], d["title_e"], d.get("cat"), None) for d in value["docs"]]
    assert [(r.mesh_id, r["count"], r.path) for r in tree.orderBy("ord").collect()] == [(t["mesh_id"], str(t["count(*)"]), t["first"]) for t in value["tree"]]
    monkeypatch.setattr(json_array, "readable", lambda path: False)  # as in a store that only Spark reads
    whole_tree, whole_docs = readers.bundle(spark, file)
    assert [r[1:] for r in map(tuple, whole_docs.orderBy("ord").collect())] == [r[:-1] for r in map(tuple, docs.orderBy("ord").collect())]
    assert whole_tree.count() == tree.count()


def test_ids_reach_the_reader(spark, file, monkeypatch):
    docs = readers.bundle(spark, file, split=2000)[1]
    ids = spark.createDataFrame([(str(k),) for k in (3, 77, 499, 900)], "pmid string")
    found = readers.wanted_docs(docs, ids)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.pmid for r in found.collect()) == ["3", "499", "77"]
    assert "BatchScan json_array" in plan and not re.search(r"\bFilter\b", plan)  # tested by the reader, so the plan has no filter left
    assert re.search(r"\bFilter\b", docs.where("pmid like '%7'")._jdf.queryExecution().executedPlan().toString())
    parsed = []
    reader = json_array.JsonArrayReader(docs.select("pmid", "ord").schema, {"extent": json.dumps([[file, *json_array.extents(spark, file, ["docs"])["docs"][0][1:]]]), "split": "2000"})
    assert list(reader.pushFilters([json_array.In(("pmid",), ("3", "77")), json_array.EqualTo(("ord",), 5)])) == [json_array.EqualTo(("ord",), 5)]
    monkeypatch.setattr(json_array.json, "loads", lambda x, f=json.loads, **k: parsed.append(x) or f(x, **k))
    assert [r for p in reader.partitions() for b in reader.read(p) for r in b.column(0).to_pylist()] == ["3", "77"]
    assert len(parsed) == 2  # the rest isn't even parsed
    many = readers.wanted_docs(docs, ids, most=2)
    assert sorted(r.pmid for r in many.collect()) == ["3", "499", "77"]


def test_folders_numbers_and_what_is_missing(spark, tmp_path):
    for name, docs in (("a.json", [{"pmid": 1, "x": 1.50, "y": {"z": [True]}}]), ("b.json", [{"pmid": "2"}, {"pmid": None, "x": False}]), ("_c", [{"pmid": "never"}])):
        (tmp_path / name).write_text(json.dumps({"docs": docs}).replace("1.5", "1.50"))
    (docs, none) = json_array.read_arrays(spark, str(tmp_path), {"docs": ["pmid", "x", "y"], "tree": ["mesh_id"]})
    assert sorted((r.pmid or "", r.x, r.y) for r in docs.collect()) == [("", "false", None), ("1", "1.50", '{"z": [true]}'), ("2", None, None)]
    assert none.count() == 0
    assert docs.where("pmid is null").count() == 1 and docs.where("pmid = '2' and x is null").count() == 1
    with pytest.raises(FileNotFoundError):
        json_array.read_arrays(spark, str(tmp_path / "nothing"), {"docs": ["pmid"]})
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "x.json").write_text('{"docs": [{"pmid": "1"}, {"pmid": tru}]}')
    with pytest.raises(Exception, match="JSON"):
        json_array.read_arrays(spark, str(tmp_path / "broken"), {"docs": ["pmid"]})[0].collect()


@pytest.mark.parametrize("files", [1, 7])
def test_a_bundle_written_by_many_tasks(spark, tmp_path, files):
    """Each file is JSON; together they hold the arrays of the one-file bundle, in order."""
    from arborlit.sources import sinks

    value = made(60)
    tree = spark.createDataFrame([(t["mesh_id"], t["web_id"], t["tree_id"], str(t["count(*)"]), t["first"]) for t in value["tree"]], "mesh_id string, web_id string, tree_id string, `count(*)` string, first string")
    docs = spark.createDataFrame([(d["pmid"], d["title_e"], d.get("cat"), "1.5") for d in value["docs"]], "pmid string, title_e string, cat string, factor string")
    sinks.write_bundle_parts(tree, docs, str(tmp_path / "p"), merged=True, files=files)
    parts = [json.loads(p.read_text()) for p in sorted((tmp_path / "p").glob("part-*")) if p.stat().st_size]
    joined = {}
    for part in parts:
        for name, records in part.items():
            joined.setdefault(name, []).extend(records)
    assert joined["docs"] == [{"pmid": d["pmid"], "title_e": d["title_e"], "cat": d.get("cat"), "factor": "1.5"} for d in sorted(value["docs"], key=lambda d: d["pmid"])]
    assert [t["mesh_id"] for t in joined["tree"]] == [t["mesh_id"] for t in sorted(value["tree"], key=lambda t: -t["count(*)"])]
    assert joined["factors"] == [{"factor": "1.5"}] * 60 and len(joined["categories"]) == 60 and set(joined) == {"tree", "docs", "factors", "categories"}
    got = readers.bundle(spark, str(tmp_path / "p"), split=500)[1].orderBy("ord").collect()
    assert [(r.pmid, r.title_e) for r in got] == [(d["pmid"], d["title_e"]) for d in joined["docs"]]
