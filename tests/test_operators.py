"""Operators on small fixtures, and their invariants."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from arborlit.operators import classify, documents, explore, incremental, latest, mentions, metrics, ontology, rollup, trees, vocabulary
from arborlit.plans import registry
from arborlit.sources import schemas as S
from arborlit.streaming import upsert


def descriptors(spark):
    return spark.createDataFrame([("D000001", "Top", ["C01"]), ("D000002", "Sub", ["C01.100", "D02.5"]), ("D000003", "Bare", []), ("D000004", "Sub", ["C01.100.7"]), ("D000005", "Odd", ["Y9.1"])], "dui string, name string, tree_numbers array<string>")


def branches(spark):
    supplements = spark.createDataFrame([("C000001", "Own", ["D000002", "D999999"]), ("C000002", "Lost", ["D999999"]), ("C000003", "None", [])], "scr string, name string, mapped_dui array<string>")
    return vocabulary.term_branches(descriptors(spark), supplements)


def test_branches(spark):
    got = {}
    for r in branches(spark).orderBy("branch_index").collect():
        got.setdefault(r.term_id, []).append((r.name, ".".join(r.path_parts), r.tree_id, r.web_id))
    assert got == {
        "D000001": [("Top", "Diseases.Top", "C01", "D000001")],
        "D000002": [("Sub", "Diseases.Top.Sub", "C01.100", "D000002"), ("Sub", "Chemicals and Drugs.Sub", "D02.5", "D000002")],
        "D000003": [("Bare", "", "", "D000003")],
        "D000004": [("Sub", "Diseases.Top.Sub", "C01.100.7", "D000004")],
        "D000005": [("Odd", "Odd", "Y9.1", "D000005")],
        "C000001": [("Own", "Diseases.Top.Sub", "C01.100", "D000002"), ("Own", "Chemicals and Drugs.Sub", "D02.5", "D000002")],
        "C000002": [("Lost", "", "", "")],
        "C000003": [("None", "", "", "")],
    }


def records(spark, rows):
    data = [(p, json.dumps({"passages": [{"text": "t", "infons": {}, "annotations": [{"id": str(k), "text": t, "infons": {"type": kind, "identifier": i}} for k, (kind, i) in enumerate(found)]}]})) for p, found in rows for t in ["x"]]
    return spark.createDataFrame(data, "pmid string, raw string").select("pmid", F.from_json("raw", S.RECORD).alias("record"))


def test_tree_and_subjects(spark):
    rows = mentions.mentions(records(spark, [("1", [("Disease", "MESH:D000002"), ("Disease", "D000003"), ("Gene", "672"), ("Chemical", "C000001"), ("Disease", "MESH:D000002")]), ("2", [("Species", "9606"), ("Disease", "OMIM:1")])]))
    facts = mentions.facts(mentions.of_kinds(rows, ("Disease", "Chemical")), branches(spark))
    assert {(r.term_id, r.path): r.n for r in trees.mention_tree(facts).collect()} == {("D000002", "Diseases.Top.Sub"): 2, ("D000002", "Chemicals and Drugs.Sub"): 2, ("C000001", "Diseases.Top.Sub"): 1, ("C000001", "Chemicals and Drugs.Sub"): 1}
    assert {r.pmid: r.names for r in mentions.subjects(facts).collect()} == {"1": ["Sub", "Bare", "Own"]}
    assert sorted((r.id, r.mesh_id, r.branch_index) for r in mentions.fact_table(facts).where("id = '2'").collect()) == [("2", "1", 0)]
    one = mentions.facts(rows, branches(spark), one_branch=True)
    assert one.count() == rows.count()
    genes = mentions.gene_mentions(rows)
    assert [(r.pmid, r.gene_id) for r in genes.collect()] == [("1", "672")]


def lineage_plain(terms, t, most=8, deepest=25):
    out = []

    def walk(at, suffix, depth, seen):
        if len(out) >= most or at not in terms:
            return
        chain = [terms[at][0], *suffix]
        up = [p for p in terms[at][1] if p in terms and p not in seen]
        if not up or depth >= deepest:
            out.append(chain)
            return
        for p in up:
            if len(out) < most:
                walk(p, chain, depth + 1, seen | {at})

    walk(t, [], 0, frozenset())
    return list(dict.fromkeys(tuple(x) for x in out))


def test_dag_lineages(spark):
    terms = {f"t{k}": (f"n{k % 9}", [f"t{p}" for p in dict.fromkeys((k * 7 // 9, k - 1, k // 2)) if 0 <= p < k]) for k in range(14)}
    terms |= {"a": ("a", ["b", "zz"]), "b": ("b", ["c"]), "c": ("c", ["a"]), "zz2": ("lone", ["missing"])}
    rows = spark.createDataFrame([(t, n, "molecular_function" if t == "a" else "", p) for t, (n, p) in terms.items()], "term_id string, name string, namespace string, parents array<string>")
    for deepest in (25, 3):
        got = {}
        for r in ontology.dag_lineages(rows, max_depth=deepest).orderBy("path_no").collect():
            got.setdefault(r.term_id, []).append(tuple(r.path_parts))
        for t in terms:
            label = "Molecular Function" if t == "a" else "Gene Ontology"
            assert got[t] == [(label, *x) for x in lineage_plain(terms, t, 8, deepest)], t


def test_gene_trees(spark):
    genes = spark.createDataFrame([("1", "a"), ("1", "a"), ("1", "b"), ("2", "a")], "pmid string, gene_id string")
    links = spark.createDataFrame([("a", "x"), ("b", "y"), ("a", "gone")], "gene_id string, class_id string")
    paths = spark.createDataFrame([("x", ["T", "X"]), ("y", ["T", "Y"])], "class_id string, path_parts array<string>")
    tree, names = trees.gene_tree(genes, trees.gene_classes("pathways", links, paths))
    assert {(r.gene_id, r.path, r.n, r.web_id, r.tree_id) for r in tree.collect()} == {("a", "T.X", 2, "hsax", "x"), ("b", "T.Y", 1, "hsay", "y")}
    assert {r.pmid: r.names for r in names.collect()} == {"1": ["X", "Y"], "2": ["X"]}
    types, _ = trees.gene_tree(genes, trees.gene_classes("types", links))
    assert {r.path for r in types.collect()} == {"x", "y", "gone"}
    docs = spark.createDataFrame([("1", "t"), ("3", "t")], "pmid string, title_e string").select("pmid", "title_e", *(F.lit("").alias(c) for c in ("journal", "doi", "year", "month", "day", "authors")))
    assert [(r.pmid, r.subjects) for r in trees.gene_documents(docs, genes, names).collect()] == [("1", "X | Y | ")]
    assert trees.known_approaches("types, terms") == ["types", "terms"]


def test_rollup(spark):
    tree = spark.createDataFrame([("g1", "A.B.C"), ("g2", "A.B.D"), ("g1", "A.E"), ("g3", "F"), ("g4", None)], "gene_id string, path string")
    docs = spark.createDataFrame([("1", "C | D | "), ("2", "C | E | nowhere | "), ("3", "F | "), ("4", None)], "pmid string, subjects string")
    nodes_docs = rollup.document_nodes(docs, tree)
    nodes = rollup.hierarchy(tree, nodes_docs)
    got = {r.path: (r.parent_path, r.depth, r.name, r.documents, r.genes) for r in nodes.collect()}
    assert got == {"A": ("", 1, "A", 2, 2), "A.B": ("A", 2, "B", 2, 2), "A.B.C": ("A.B", 3, "C", 2, 1), "A.B.D": ("A.B", 3, "D", 1, 1), "A.E": ("A", 2, "E", 1, 1), "F": ("", 1, "F", 1, 1)}
    for path, (parent, *_rest) in got.items():
        if parent:
            below = {r.pmid for r in nodes_docs.where(F.col("path") == path).collect()}
            assert below <= {r.pmid for r in nodes_docs.where(F.col("path") == parent).collect()}
    assert {r.path for r in rollup.leaf_nodes(nodes).collect()} == {"A.B.C", "A.B.D", "A.E", "F"}
    pruned = rollup.prune(nodes, rollup.node_genes(tree), 1)
    assert {(r.parent_path, r.path, r.name, r.documents, r.genes) for r in pruned.collect()} == {("", "A", "A", 2, 2), ("", None, "1 more", 1, 1), ("A", "A.B", "B", 2, 2), ("A", None, "1 more", 1, 1), ("A.B", "A.B.C", "C", 2, 1), ("A.B", None, "1 more", 1, 1)}
    assert {r.path for r in rollup.prune(nodes, rollup.node_genes(tree), 5, 1, "A").collect()} == {"A.B", "A.E"}
    assert {r.path: r.width for r in rollup.layout_sums(pruned).collect()} == {"A": 4, "A.B": 3, "A.B.C": 2}
    full = spark.createDataFrame([("1", "", "J; x", "2020", "3", ""), ("2", "T", "K", "2021", "", "")], "pmid string, title_e string, journal string, year string, month string, day string")
    assert [(r.pmid, r.title, r.journal, r.date) for r in rollup.documents_of(full, nodes_docs, "A.B.C").collect()] == [("2", "T", "K", "2021"), ("1", "(untitled)", "J", "2020-03")]
    assert rollup.most_documents(nodes).first().documents == 2


def test_split_merge_fill(spark):
    tree = spark.createDataFrame([("a", "Diseases.x", 3), ("b", "Anatomy.y", 1), ("c", "Organisms.x", 2), ("d", "", 1)], "mesh_id string, path string, n long")
    docs = spark.createDataFrame([("1", "x | "), ("2", "y | q | "), ("3", "")], "pmid string, subjects string")
    bucketed, split = trees.split_tree(tree, docs)
    sizes = trees.bucket_sizes(bucketed).collect()
    assert [(r.bucket, r.slug, r.entries) for r in sizes] == [("other", "other", 2), ("", "", 1), ("Diseases", "diseases", 1)]
    assert sum(r.entries for r in sizes) == tree.count()
    assert {(r.bucket, r.pmid) for r in split.collect()} == {("Diseases", "1"), ("other", "1"), ("other", "2")}
    a = spark.createDataFrame([("k", "p", 2, "w", "t")], "mesh_id string, path string, n long, web_id string, tree_id string")
    assert [tuple(r) for r in trees.merge_counts(a, a.limit(0), ("mesh_id", "path")).collect()] == [("k", "p", 2, "w", "t")]
    other = spark.createDataFrame([("1", "c", "", "f"), ("2", "z", "h", "")], "pmid string, cat string, hard_category string, format string")
    mine = spark.createDataFrame([("1", "", None, "own"), ("2", "keep", "", ""), ("3", "", "", "")], "pmid string, cat string, hard_category string, format string")
    filled = trees.fill_blanks(mine, other)
    assert {r.pmid: (r.cat, r.hard_category, r.format) for r in filled.collect()} == {"1": ("c", "", "own"), "2": ("keep", "h", ""), "3": ("", "", "")}
    assert tuple(trees.fill_counts(filled).first()) == (1, 1, 0, 2)


def test_incremental_equals_rebuild(spark):
    rows = [("1", [("Disease", "D000002")]), ("2", [("Disease", "D000001"), ("Chemical", "D000002")]), ("3", [("Disease", "D000009")])]
    whole = trees.mention_tree(mentions.facts(mentions.mentions(records(spark, rows)), branches(spark)))
    first = trees.mention_tree(mentions.facts(mentions.mentions(records(spark, rows[:1])), branches(spark))).withColumnRenamed("term_id", "mesh_id").withColumn("ord", F.lit(0))
    docs = spark.createDataFrame([("1", "Sub | ", 0), ("2", "", 1), ("3", "", 2)], "pmid string, subjects string, ord int")
    done = incremental.enrich_subjects(docs, first, records(spark, rows), branches(spark))
    assert {(r.mesh_id, r.path, r.n) for r in done.tree.collect()} == {(r.term_id, r.path, r.n) for r in whole.collect()}
    assert {r.pmid: r.subjects for r in done.documents.collect()} == {"1": "Sub | ", "2": "Top | Sub | ", "3": ""}
    assert [r.term_id for r in done.unresolved.collect()] == ["D000009"]
    assert [r.pmid for r in incremental.targets(docs, ["3", "1"], 1).collect()] == ["3"]


def test_metrics(spark):
    docs = spark.createDataFrame([("1", "ok"), ("2", "ok"), ("3", "failed")], "pmid string, fetch_status string")
    value = "key string, value struct<citation_count:long,relative_citation_ratio:double,nih_percentile:double>"
    m = spark.createDataFrame([("1", (5, 1.5, 2.5)), ("2", None)], value)
    works = spark.createDataFrame([("1", ("S1",)), ("2", ("",))], "key string, value struct<source_id:string>")
    sources = spark.createDataFrame([("S1", ("J", 3.5))], "key string, value struct<display_name:string,two_yr_mean_citedness:double>")
    got = {r.pmid: tuple(r)[1:] for r in metrics.citation_table(docs, m, works, sources).collect()}
    assert got == {"1": (5, 1.5, 2.5, "J", 3.5), "2": (None, None, None, None, None)}
    assert [r.key for r in metrics.work_sources(works).collect()] == ["S1"]
    assert metrics.missing_keys(docs.toDF("key", "x"), m).first().key == "3"
    full = docs.select("pmid", "fetch_status", *(F.lit("v").alias(c) for c in ("title_e", "journal", "doi", "year", "month", "day", "authors")))
    names = spark.createDataFrame([("1", ["a"])], "pmid string, names array<string>")
    rows = {r.pmid: r for r in documents.bundle_documents(full, names, metrics.citation_table(docs, m, works, sources)).collect()}
    assert (rows["1"].number_citations, rows["1"].factor, rows["1"].subjects, rows["2"].number_citations, rows["2"].subjects) == ("5", "3.5", "a | ", "", "")
    assert len(rows["1"]) == 29


def test_latest_and_batches(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 1, "z")], "k string, ord int, v string")
    assert {tuple(r) for r in latest.last_wins(rows, ["k"], ["ord"]).collect()} == {("a", 2, None), ("b", 1, "z")}
    assert {tuple(r) for r in latest.first_seen(rows, ["k"], ["ord"]).collect()} == {("a", 1, "x"), ("b", 1, "z")}
    many = spark.range(100).select(F.col("id").alias("n"))
    got = {r.n: r.batch for r in latest.batch_number(many, 20, ["n"]).collect()}
    assert got == {k: k // 20 + 1 for k in range(100)}


def test_explorer(spark):
    rows = spark.createDataFrame([(str(k), f"name{k}", None if k % 2 else "x") for k in range(60)], "id string, name string, note string")
    got = explore.explore(rows, " NAME ", ["id", "note"], ["name"], "id", number=99)
    assert [r.id for r in got.collect()] == [str(k) for k in range(50, 60)]
    assert {r.note for r in got.collect()} == {"x", "—"}
    assert explore.explore(rows, sort="id", descending=True).first().id == "59"
    assert explore.explore(rows, "name7", sort="id").count() == 1


def test_classifier(spark):
    rows = [(str(k), f"{'heart attack study' if k % 2 else 'virus spread model'} number{k}", "", "a | " if k % 2 else "b | ", "" if k % 10 == 0 else ("cardio" if k % 2 else "infect")) for k in range(80)]
    docs = spark.createDataFrame(rows, "pmid string, title_e string, abstract string, subjects string, hard_category string")
    trained = classify.train(docs, "hard_category", iterations=20)
    got = {r.pmid: r for r in classify.predict(trained, docs, "hard_category").collect()}
    assert got.keys() == {str(k) for k in range(0, 80, 10)}
    assert all(r.hard_category_predicted == "infect" and 0.5 < r.hard_category_predicted_confidence <= 1 for r in got.values())
    assert {r.label: r.f1 for r in trained.report.collect()} == {"cardio": 1.0, "infect": 1.0}
    assert classify.train(docs.limit(5), "hard_category") is None
    assert classify.sample(docs, 5).collect() == classify.sample(docs.repartition(7), 5).collect()


def test_registry():
    assert len(registry.RESULTS) == 14 and registry.result("nope").id == "documents"
    assert sum(r.available for r in registry.RESULTS) == 13
    assert all(r.default_sort in r.columns and set(r.searchable) <= r.columns.keys() for r in registry.RESULTS if r.available)


def test_streaming_upsert(spark, tmp_path):
    source, schema = tmp_path / "in", "k string, ord int, v string"
    source.mkdir()
    for n, lines in enumerate((['{"k":"a","ord":1,"v":"x"}', '{"k":"b","ord":1,"v":"y"}'], ['{"k":"a","ord":2,"v":"z"}', '{"k":"c","ord":0,"v":"w"}'])):
        (source / f"{n}.json").write_text("\n".join(lines))
        stream = upsert.record_stream(spark, str(source), schema, 1)
        upsert.upsert_latest(stream, str(tmp_path / "out"), str(tmp_path / "ck"), ["k"], ["ord"]).awaitTermination(60)
    got = upsert.latest_version(spark, str(tmp_path / "out"))
    assert {(r.k, r.v) for r in got.collect()} == {("a", "z"), ("b", "y"), ("c", "w")}


def test_windowed_counts(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "0.json").write_text('{"t":"2021-01-01T00:10:00Z","k":"a"}\n{"t":"2021-01-01T00:50:00Z","k":"a"}\n{"t":"2021-01-01T09:00:00Z","k":"a"}')
    stream = spark.readStream.schema("t timestamp, k string").json(str(tmp_path / "in"))
    run = upsert.counts_by_window(stream, "t", "k").writeStream.format("memory").queryName("windowed").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    run.awaitTermination(60)
    assert [r.n for r in spark.table("windowed").collect()] in ([2], [2, 1])


def test_programs(spark):
    from arborlit.plans import programs

    rows = records(spark, [("1", [("Disease", "D000002"), ("Gene", "672"), ("Species", "9606")]), ("2", [("Gene", "Gene:675;672")])])
    full = spark.createDataFrame([("1", "ok"), ("2", "ok"), ("3", "failed")], "pmid string, fetch_status string").select("pmid", "fetch_status", *(F.lit("v").alias(c) for c in ("title_e", "journal", "doi", "year", "month", "day", "authors")))
    built = programs.build_tree(rows, descriptors(spark), docs=full)
    assert [(r.mesh_id, r["count(*)"], r["first"]) for r in built.tree.collect()] == [("D000002", "1", "Chemicals and Drugs.Sub"), ("D000002", "1", "Diseases.Top.Sub")]
    assert {r.pmid: r.subjects for r in built.documents.collect()} == {"1": "Sub | ", "2": ""}
    assert programs.build_tree(rows, descriptors(spark), kinds=None).facts.count() == 5
    assert programs.build_tree(rows, descriptors(spark), one_branch=True).tree.count() == 1
    assert programs.build_tree(rows, descriptors(spark), kinds=None, limit=1).facts.count() == 4
    pairs = lambda *p: spark.createDataFrame(list(p), "gene_id string, class_id string")
    references = {
        "terms": pairs(("672", "B"), ("675", "A"), ("1", "Z")),
        "ontology": spark.createDataFrame([("A", "a", "", []), ("B", "b", "", ["A"])], "term_id string, name string, namespace string, parents array<string>"),
        "groups": spark.createDataFrame([("672", ["L", "G"]), ("675", ["L"])], "gene_id string, path_parts array<string>"),
        "pathways": pairs(("672", "00010")),
        "outline": spark.createDataFrame([("00010", ["T", "P"])], "class_id string, path_parts array<string>"),
        "types": pairs(("672", "coding")),
    }
    got = programs.gene_trees(rows, references, full)
    assert {(k, r.gene_id, r["first"], r["count(*)"]) for k, b in got.items() for r in b.tree.collect()} == {
        ("terms", "672", "Gene Ontology.a.b", "2"),
        ("terms", "675", "Gene Ontology.a", "1"),
        ("groups", "672", "L.G", "2"),
        ("groups", "675", "L", "1"),
        ("pathways", "672", "T.P", "2"),
        ("types", "672", "coding", "2"),
    }
    assert {r.pmid: r.subjects for r in got["groups"].documents.collect()} == {"1": "G | ", "2": "G | L | "}
    mine = spark.createDataFrame([("1", "", "", "", 0), ("2", "x", "", "", 1)], "pmid string, cat string, hard_category string, format string, ord int")
    theirs = spark.createDataFrame([("1", "c", "", "f", 0), ("2", "y", "h", "", 1)], "pmid string, cat string, hard_category string, format string, ord int")
    filled, counts = programs.merge_reference(mine, theirs, limit=1)
    assert {r.pmid: (r.cat, r.hard_category, r.format) for r in filled.collect()} == {"1": ("c", "", "f"), "2": ("x", "", "")}
    assert tuple(counts.first()) == (1, 0, 1, 1)


def test_counting_before_joining_gives_the_same_tree(spark):
    rows = mentions.mentions(records(spark, [(str(k), [("Disease", f"D00000{1 + (k + j) % 6}") for j in range(k % 5)] + [("Chemical", "C000001")]) for k in range(12)]))
    facts = mentions.facts(rows, branches(spark))
    short = trees.term_tree(mentions.resolvable(rows, ("Chemical", "Disease")), branches(spark))
    key = lambda t: {tuple(r) for r in t.select("term_id", "path", "n", "web_id", "tree_id").collect()}
    assert key(short) == key(trees.mention_tree(facts))
