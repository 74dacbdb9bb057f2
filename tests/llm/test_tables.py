"""Operators over pages, conversations and embeddings, the pipeline, and the registered queries."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest

from arborlit.llm import components, maxscore, queries, reply_trees, warc_audit

import corpus_pipeline

DATA = Path("/root/testdata")
WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text, width=5):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()


def test_components(spark):
    rng = np.random.default_rng(0)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(k, k + 1) for k in range(1000, 1100)] + [(7, 7)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_reply_tree_branches(spark):
    rows = [
        (1, 10, None, "user", "hi <b> # \\h", 1.0),
        (1, 11, 10, "assistant", "a", 2.0),
        (1, 12, 10, "assistant", "b", 5.0),
        (1, 13, 12, "odd: role#", None, None),
        (1, 14, 12, "user", "", -1.0),
        (2, 1, 99, None, "root by missing parent", None),
        (3, 1, 2, "user", "cycle", 1.0),
        (3, 2, 1, "user", "cycle", 1.0),
        *[(4, k, k - 1 if k else None, "user", str(k), 0.0) for k in range(37)],
    ]
    nodes = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    got = {}
    for r in reply_trees.branches(nodes).orderBy("turn").collect():
        got.setdefault((r.tree, r["rank"], r.leaf), []).append(r.text)
    assert got == {
        (1, 1, 13): ["hi <b> # \\h", "b", ""],
        (1, 2, 14): ["hi <b> # \\h", "b", ""],
        (1, 3, 11): ["hi <b> # \\h", "a"],
        (2, 1, 1): ["root by missing parent"],
        (4, 1, 36): [str(k) for k in range(37)],
    }
    best = reply_trees.format_branches(reply_trees.branches(nodes, top=1))
    back = sorted((r.tree, r.turn, r.role, r.text, r.learned) for r in reply_trees.read_back(best).where("tree < 4").collect())
    assert back == [(1, 0, "user", "hi <b> # \\h", None), (1, 1, "assistant", "b", "b"), (1, 2, "odd: role#", "", None), (2, 0, "", "root by missing parent", None)]
    for r in best.where("tree = 1").collect():
        assert [r.formatted[s.start : s.end] for s in r.loss_spans] == ["b"]


def test_conversations(spark):
    rows = [(5, 1, "assistant", "</turn>\n### User: \\", 1), (5, 0, "user", None, 1), (6, 0, None, "x\ny", 1), (6, 0, "assistant", "\U0001f600", 1), (6, None, "system", "s", 1), (None, 0, "user", "gone", 1), (5, 1, "assistant", "</turn>\n### User: \\", 1), (8, 3, "assistant", "", 1)]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, tree long")
    shown = reply_trees.format_conversations(messages).withColumnRenamed("conv_id", "tree")
    back = {}
    for r in reply_trees.read_back(shown).orderBy("turn").collect():
        back.setdefault(r.tree, []).append((r.role, r.text, r.learned))
    hard = "</turn>\n### User: \\"
    assert back == {5: [("user", "", None), ("assistant", hard, hard), ("assistant", hard, hard)], 6: [("system", "s", None), ("", "x\ny", None), ("assistant", "\U0001f600", "\U0001f600")], 8: [("assistant", "", "")]}
    assert reply_trees.format_conversations(messages.limit(0)).count() == 0


def test_top_k(spark):
    rng = np.random.default_rng(4)
    made = np.round(rng.normal(0, 0.2, (300, 12)), 3)
    made[100:140] = made[100]
    rows = [(k, [float(x) for x in v], "x") for k, v in enumerate(made)]
    rows += [(1000, None, "x"), (1001, [1.0, None], "x"), (1002, [float("nan")] * 12, "x"), (1003, [float("inf")] * 12, "x"), (None, [1.0] * 12, "x"), (1004, [0.5, -0.25], "x"), rows[3], (1005, [], "x")]
    whole = {d: np.floor(256 * np.array(v + [0.0] * (12 - len(v)))).astype(int) for d, v, _ in rows if d is not None and d not in (1000, 1001, 1002, 1003)}
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    from pyspark.sql import functions as F

    got = sorted(tuple(r) for r in maxscore.top_k(vectors, F.col("vec_id") % 10 == 0, 5).collect())
    expected = []
    for q in whole:
        if q % 10 == 0:
            best = sorted(((-int(whole[q] @ v), d) for d, v in whole.items() if d != q))[:5]
            expected += [(q, k + 1, d, -s) for k, (s, d) in enumerate(best)]
    assert got == sorted(expected)
    few = maxscore.top_k(vectors.where("vec_id in (0, 7, 8)"), F.col("vec_id") % 10 == 0, 5).collect()
    assert [r["rank"] for r in few] == [1, 2]
    assert maxscore.top_k(vectors.limit(0), F.col("vec_id") % 10 == 0, 5).count() == 0


def test_shards_merge(spark, monkeypatch):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(9)
    vectors = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in enumerate(rng.normal(0, 0.3, (400, 8)))], "vec_id long, embedding array<double>")
    ask = lambda: sorted(tuple(r) for r in maxscore.top_k(vectors, F.col("vec_id") % 7 == 0, 3).collect())
    one = ask()
    monkeypatch.setattr(maxscore, "SHARD_ROWS", 50)
    monkeypatch.setattr(maxscore, "QUERY_ROWS", 20)
    assert ask() == one


def test_essential_segments_skip_rows(spark, monkeypatch):
    """On clustered vectors most rows lie in no essential segment and are never probed; results stay exact."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(12)
    centres = rng.normal(0, 0.1, (20, 24))
    centres[np.arange(20), np.arange(20)] += 2.0
    made = centres[np.arange(3000) % 20] + rng.normal(0, 0.02, (3000, 24))
    vectors = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in enumerate(made)], "vec_id long, embedding array<double>")
    ask = F.col("vec_id") % 50 == 0
    told = maxscore.work(vectors, ask, 5).first()
    assert told.seen == 60 * 3000
    assert told.probed <= told.essential <= 0.3 * told.seen
    whole = np.floor(256 * made).astype(int)
    got = sorted(tuple(r) for r in maxscore.top_k(vectors, ask, 5).collect())
    assert got == sorted(plain_top_k(whole, 50))
    for segments in (1, 3, 500):
        monkeypatch.setattr(maxscore, "SEGMENTS", segments)
        assert sorted(tuple(r) for r in maxscore.top_k(vectors.where("vec_id < 400"), ask, 5).collect()) == sorted(plain_top_k(whole[:400], 50))


def plain_top_k(whole, every, k=5):
    out = []
    for q in range(0, len(whole), every):
        best = sorted((-int(s), d) for d, s in enumerate(whole @ whole[q]) if d != q)[:k]
        out += [(q, n + 1, d, -s) for n, (s, d) in enumerate(best)]
    return out


def test_warc_audit(spark):
    from pyspark.sql import functions as F

    rows = [(k, f"http://x/{k}", f"<p>é{k}</p>" * (k % 5), "x") for k in range(600)] + [(7, None, None, "x"), (7, None, None, "x"), (None, "u", "h", "x"), (None, "u", "h", "x"), (900, "u", "", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, book string")
    ours = warc_audit.records(pages)
    same = warc_audit.audit(ours, ours.repartition(5)).collect()
    assert len(same) == len(rows) and not any(r.corrupt or r.shifted for r in same) and all(r.root == r.replica_root for r in same)
    assert {hashlib.sha256(r.record.encode()).hexdigest() for r in ours.collect()} == {r.sha256 for r in same}
    by_file = {}
    for r in same:
        by_file.setdefault(r.file, []).append((r.offset, r.length))
    for spans in by_file.values():
        ends = [0]
        for low, size in sorted(spans):
            assert low == ends[-1]
            ends.append(low + size)

    damaged = pages.withColumn("html", F.when(F.col("page_id").isin(3, 300), F.lit("?")).otherwise(F.col("html"))).where("page_id is null or page_id <> 599").dropDuplicates()
    got = warc_audit.audit(ours, warc_audit.records(damaged)).collect()
    assert Counter(r.page_id for r in got if r.corrupt) == Counter([3, 300, 599, 7, None])
    assert {r.page_id for r in got if r.shifted} == {*range(4, 256), *range(301, 512)}
    assert {r.file for r in got if r.root != r.replica_root} == {0, 1, 2, None}
    # the replica lacks a file, and has one more
    other = warc_audit.records(pages.where("page_id < 512").unionByName(pages.where("page_id = 900").withColumn("page_id", F.lit(5000).cast("long"))))
    assert {(r.page_id, r.replica_root) for r in warc_audit.audit(ours, other).collect() if r.corrupt} == {(r.page_id, None) for r in same if r.page_id is None or r.page_id >= 512}
    assert warc_audit.audit(ours.limit(0), ours).count() == 0
    assert all(r.corrupt for r in warc_audit.audit(ours, ours.limit(0)).collect())
    blank = ours.withColumn("record", F.when(F.col("page_id") != 5, F.col("record")))
    assert Counter(r.page_id for r in warc_audit.audit(ours, blank).where("corrupt").collect()) == Counter([5, None, None])


def test_damaged_pages_are_those_reported(spark):
    pages = spark.read.parquet(str(DATA / "sf0.01" / "pages.parquet"))
    replica = warc_audit.with_rot(pages)
    changed = {r.page_id for r in pages.join(replica.withColumnRenamed("html", "other"), "page_id").where("html <> other").collect()}
    got = warc_audit.audit(warc_audit.records(pages), warc_audit.records(replica)).where("corrupt").collect()
    assert pages.count() == 250 and len(changed) == 5
    assert sorted(r.page_id for r in got) == sorted(changed)


def test_warc_files(spark, tmp_path):
    """An archive written as files, read back, and audited after damage to its bytes."""
    rows = [(k, f"http://x/{k}", f"<p>{k}</p>" if k % 3 else "two\r\n\r\nparts WARC/1.1 é") for k in range(300)]
    ours = warc_audit.records(spark.createDataFrame(rows, "page_id long, url string, html string"))
    for side in ("ours", "theirs"):
        warc_audit.write_archive(ours, str(tmp_path / side))
    back = warc_audit.read_archive(spark, str(tmp_path / "ours"))
    assert {(r.file, r.page_id, bytes(r.record)) for r in back.collect()} == {(r.file, r.page_id, r.record.encode()) for r in ours.collect()}
    (path,) = (tmp_path / "theirs" / "file=1").glob("part-*")
    whole = path.read_bytes()
    data = bytearray(whole)
    data[data.index(b"<p>259</p>") + 3] ^= 1  # content
    at = data.index(b"Content-Length", data.index(b"<urn:page:270>"))
    data[at + 16 : at + 17] = b"x"  # framing
    path.write_bytes(bytes(data[:-3]))  # cut short
    (path.parent / f".{path.name}.crc").unlink()  # the local file system's own checksum would stop the read
    got = warc_audit.audit(back, warc_audit.read_archive(spark, str(tmp_path / "theirs"))).where("corrupt or shifted").collect()
    assert sorted(r.page_id for r in got if r.corrupt) == [259, 270, 299]
    assert not any(r.shifted for r in got)
    assert b"".join(warc_audit.cut_records(whole)) == whole and list(warc_audit.cut_records(b"")) == []
    assert [warc_audit.page_of(x) for x in warc_audit.cut_records(b"junk" + whole[:-3])] == [None, *range(256, 300)]


def test_one_bad_record_of_equal_length(spark):
    pages = spark.createDataFrame([(k, "u", f"page {k:04d}") for k in range(5000)], "page_id long, url string, html string")
    from pyspark.sql import functions as F

    other = pages.withColumn("html", F.when(F.col("page_id") == 4321, F.lit("page 9999")).otherwise(F.col("html")))
    got = warc_audit.audit(warc_audit.records(pages), warc_audit.records(other)).where("corrupt or shifted").collect()
    assert [r.page_id for r in got] == [4321]


def test_cycles_repeats_and_nulls_in_trees(spark):
    schema = "tree long, node long, parent long, role string, text string, score double, extra int"
    rows = [
        (1, 1, 2, "a", "cycle", 1.0, 1),
        (1, 2, 1, "a", "cycle", 1.0, 1),
        (1, 3, 1, "a", "leaf below a cycle", 2.0, 1),
        (1, 9, None, "a", "apart", 0.0, 1),
        (2, 1, None, "a", "root", 3.0, 1),
        (2, 1, None, "a", "root", 3.0, 1),
        (2, 2, 1, "b", "reply", 1.0, 1),
        (2, 2, 1, "b", "reply", 1.0, 1),
        (2, 2, 1, "c", "reply held back", 9.0, 1),
        (3, 5, 5, "a", "own parent", 1.0, 1),
        (None, 1, None, "a", "no tree", 1.0, 1),
        (4, None, None, "a", "no node", 1.0, 1),
        (4, 1, None, None, None, None, 1),
    ]
    # a long tail below a cycle in a tree of its own
    rows += [(5, k, 40 if k == 0 else k - 1, "a", "x", 1.0, 1) for k in range(60)]
    nodes = spark.createDataFrame(rows, schema)
    got = sorted((r.tree, r.leaf, r["rank"], r.branch_score, r.turn, r.role, r.text) for r in reply_trees.branches(nodes).collect())
    assert got == [(1, 9, 1, 0.0, 0, "a", "apart"), (2, 2, 1, 4.0, 0, "a", "root"), (2, 2, 1, 4.0, 1, "b", "reply"), (4, 1, 1, 0.0, 0, "", "")]
    assert reply_trees.branches(nodes.limit(0)).count() == 0
    assert reply_trees.format_branches(reply_trees.branches(nodes.limit(0))).count() == 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_match_sql(spark, sf_small, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "conversations", "benchmark"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_small}/{table}.parquet')")
    got, expected = queries.queries()[name](spark, sf_small), con.sql(queries.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(expected.columns)
    place = [expected.columns.index(c) for c in columns]
    # rows as Python values, as frames show nulls among whole numbers in two ways
    assert Counter(tuple(str(r[c]) for c in columns) for r in got.collect()) == Counter(tuple(str(r[k]) for k in place) for r in expected.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(queries.oracle_sql())))
def test_other_queries_cover_all_rows(spark, sf_small, name):
    got = queries.queries()[name](spark, sf_small)
    assert got.count() == spark.read.parquet(f"{sf_small}/documents.parquet").count()


def test_near_copies_leave_one_row(spark, sf_small):
    one, two = (" ".join(f"{w}{k}" for k in range(60)) for w in ("a", "b"))
    rows = [(9, one), (5, one), (5, one), (None, one), (5, one + " more"), (None, two), (None, two), (7, "alone on its own here"), (7, "another text of that id"), (None, "other"), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = corpus_pipeline.drop_near_copies(spark, docs, sf_small).collect()
    groups = Counter((r.doc_id, (r.text or "").removesuffix(" more")) for r in got)
    assert groups == Counter([(5, one), (None, two), (7, "alone on its own here"), (7, "another text of that id"), (None, "other"), (8, "")])


def chosen_documents(docs):
    """The rows that the mixing stage takes of ``docs`` (dicts): plain loops over sources, in hash order."""
    size = [len(WORD.findall(d["text"] or "")) for d in docs]
    place = [int(hashlib.md5((str(d["doc_id"]) if d["doc_id"] is not None else "null").encode()).hexdigest()[:15], 16) for d in docs]
    names = sorted({d["source"] for d in docs}, key=lambda x: (x is None, x or ""))
    whole = {s: sum(n for n, d in zip(size, docs, strict=True) if d["source"] == s) for s in names}
    weight, target, left = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}, {}, 1.5 * sum(size)
    open_ = set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * whole[s]}
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: 2.0 * whole[s] for s in over}
        left, open_ = left - sum(2 * whole[s] for s in over), open_ - over
    taken = []
    for s in names:
        if not whole[s]:
            continue
        copies = int(target[s] // whole[s])
        own = sorted((place[k], k) for k, d in enumerate(docs) if d["source"] == s)
        rest, limit = target[s] - copies * whole[s], None
        sums = Counter()
        for h, k in own:
            sums[h] += size[k]
        upto = 0
        for h in sorted(sums):
            upto += sums[h]
            if upto > rest:
                limit = h + (upto - rest < rest - (upto - sums[h]))
                break
        for h, k in own:
            taken += [k] * (copies + (limit is not None and h < limit))
    return taken


def test_pipeline(spark, sf_small):
    """Every stage against plain loops, on rows with extra columns of clashing names, nulls, repeats and ties."""
    from pyspark.sql import functions as F

    import tiktoken

    from arborlit.llm import bpe, secret_scan, toxicity

    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    clash = ("h", "whole", "limit", "target", "source_size", "copies", "row", "h1", "score", "predicted", "base", "spans", "component_id", "size")
    odd = [(None, None), (None, "no id but words enough to be a text"), (10**6, None), (10**6 + 1, ""), (10**6 + 1, "one id, another text that is short"), (10**6 + 2, "password = abcdefghijklmn0123"), (10**6 + 2, "password = abcdefghijklmn0123")]
    more = spark.createDataFrame([(d, t, None, f"s{k % 2}" if k else None, None) for k, (d, t) in enumerate(odd)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.unionByName(more).select("*", *(F.lit(k).alias(c) for k, c in enumerate(clash)))
    columns, held, states = docs.columns, docs, [[r.asDict() for r in docs.collect()]]
    for name, stage in corpus_pipeline.STAGES:
        held = stage(spark, held, sf_small)
        held.write.mode("overwrite").parquet(f"{corpus_pipeline.checkpoint_dir(spark)}/test-{name}")
        held = spark.read.parquet(f"{corpus_pipeline.checkpoint_dir(spark)}/test-{name}")
        assert name == "byte_bpe" or held.columns == columns
        states.append([r.asDict() for r in held.collect()])
    raw, mild, single, clean, mixed, last = states
    bag = lambda rows: Counter(tuple(r[c] for c in columns) for r in rows)
    # toxicity: what the model flags goes (test_convolution holds its scores against loops), and nothing else
    model = toxicity.train(docs, spark.read.parquet(f"{sf_small}/labels.parquet"))
    alone = spark.createDataFrame([(k, r["text"]) for k, r in enumerate(raw)], "doc_id long, text string")
    rejected = {r.doc_id for r in toxicity.score(alone, model).where("predicted = 1").collect()}
    assert bag(mild) == bag(r for k, r in enumerate(raw) if k not in rejected)
    # near copies: one row of each component, the smallest doc_id, nulls last
    sets = [frozenset(shingles(r["text"])) for r in mild]
    parent = list(range(len(mild)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, x in enumerate(sets):
        for j in range(k):
            y = sets[j]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                parent[find(k)] = find(j)
    groups = {}
    for k, r in enumerate(mild):
        groups.setdefault(find(k), []).append((r["doc_id"] is None, r["doc_id"] or 0, r))
    assert Counter(r["doc_id"] for r in single) == Counter(min(g, key=lambda x: x[:2])[2]["doc_id"] for g in groups.values())
    assert not bag(single) - bag(mild)
    # secrets: every stretch of spans is replaced, the rest stays
    spans = {(r.doc_id, r.text): r.spans for r in secret_scan.scan(spark.createDataFrame([(r["doc_id"], r["text"]) for r in single], "doc_id long, text string")).collect()}
    expected = Counter()
    for r in single:
        text, out, at = r["text"] or "", [], 0
        for s in spans[(r["doc_id"], text)]:
            if s.start >= at:
                out += [text[at : s.start], "[SECRET]"]
            at = max(at, s.end)
        text = "".join([*out, text[at:]])
        expected[tuple({**r, "text": text, "n_chars": len(text)}[c] for c in columns)] += 1
    assert bag(clean) == expected
    # mix
    assert bag(mixed) == bag(clean[k] for k in chosen_documents(clean))
    # tokens, by the library
    library = tiktoken.Encoding("x", pat_str=corpus_pipeline.public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(corpus_pipeline.VOCABULARY), special_tokens={})
    want = Counter((r["doc_id"], np.array(library.encode_ordinary(r["text"]), dtype="<u4").tobytes(), hashlib.sha256(r["text"].encode()).hexdigest()) for r in mixed)
    assert Counter((r["doc_id"], bytes(r["ids"]), r["decoded_sha256"]) for r in last) == want
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in last)


def test_pipeline_as_a_whole(spark, sf_small):
    folder = corpus_pipeline.checkpoint_dir(spark)
    got = corpus_pipeline.run(spark, sf_small)
    assert got.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"] and got.count() > 50
    kept = [x for x in Path(folder.removeprefix("file:")).glob("pipeline-*/*")]
    assert {x.name for x in kept} == {"mix_sources"}
    empty = spark.read.parquet(f"{sf_small}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, sf_small)
        assert empty.count() == 0


def test_only_chosen_branches_are_laid_out(spark, monkeypatch):
    """A spine of 2000 nodes with a leaf at each: all leaves are ranked, three branches are laid out."""
    n = 2000
    rows = [(1, k, k - 1 if k else None, "user", None, 1.0 if k % 2 else -0.5) for k in range(n)] + [(1, n + k, k, "user", None, float(k * 7919 % 101)) for k in range(n)]
    nodes = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    made = []
    monkeypatch.setattr(reply_trees, "durable", lambda df, f=reply_trees.durable: made.append(f(df)) or made[-1])
    got = reply_trees.branches(nodes, top=3).select("leaf", "rank", "branch_score").distinct().orderBy("rank").collect()
    spine = [0.0]
    for k in range(n):
        spine.append(spine[-1] + rows[k][5])
    best = sorted(((-(spine[k + 1] + rows[n + k][5]), n + k) for k in range(n)))[:3]
    assert [(r.branch_score, r.leaf) for r in got] == [(-s, leaf) for s, leaf in best]
    assert sum(df.count() for df in made) < 100_000 and max(df.count() for df in made) <= 3 * (n + 1)  # all paths would be 2,003,000 rows
