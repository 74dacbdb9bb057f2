"""The substring index and stored pages."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from arborlit.operators import explore, pages, textindex


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    rng = random.Random(4)
    words = ["Gene", "genome", "été", "cell", "abc", "Ab", "\U0001f600x", "zz", "protein"]
    rows = [(k, rng.choice([None, "", " ".join(rng.choices(words, k=6))]) if k % 5 else " ".join(rng.choices(words, k=3)), rng.choice(words)) for k in range(3000)]
    rows.append((3000, "a needle here", "cell"))
    path = str(tmp_path_factory.mktemp("index"))
    textindex.build(spark.createDataFrame(rows, "id int, title string, kind string").repartition(5), ["title", "kind"], path, ["id"], 8)
    return rows, path


@pytest.mark.parametrize("query", ["needle", "Gene", "e g", "ab", "x", "  ", None, "été", "nothing like it", "\U0001f600x z", "genome cell", "zzz"])
@pytest.mark.parametrize("columns", [None, ["kind"]])
def test_searches_match_a_scan(spark, index, query, columns):
    rows, path = index
    wanted = (query or "").strip().lower()
    expected = sorted(r[0] for r in rows if any(wanted in (r[1 + c] or "").lower() for c in ((0, 1) if columns is None else (1,))))
    found = textindex.search(spark, path, query, columns)
    assert found.rows.columns == ["id", "title", "kind"]
    assert sorted(r.id for r in found.rows.collect()) == expected
    assert (found.candidates is None) == (len(wanted) < 3)


def test_only_candidates_are_read(spark, index):
    _, path = index
    found = textindex.search(spark, path, "needle", ["title"])
    assert found.candidates == 1 and found.rows.count() == 1
    plan = found.rows._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "number" in plan.split("PushedFilters")[1]
    with pytest.raises(ValueError, match="not indexed"):
        textindex.search(spark, path, "needle", ["id"])


def test_the_index_lists_rows_by_runs(spark, index):
    """A trigram has a row for each run of rows and not for each row that holds it; the lists say what trigrams() says."""
    rows, path = index
    held, table = spark.read.parquet(f"{path}/places"), spark.read.parquet(f"{path}/rows")
    listed = held.select("field", "gram", F.explode("offsets").alias("k"), "base").select("field", "gram", (F.col("base") + F.col("k")).alias("number"))
    plain = table.select(F.lit("title").alias("field"), F.explode(textindex.trigrams(F.col("title"))).alias("gram"), "number").unionByName(table.select(F.lit("kind").alias("field"), F.explode(textindex.trigrams(F.col("kind"))).alias("gram"), "number"))
    assert listed.exceptAll(plain).isEmpty() and plain.exceptAll(listed).isEmpty()
    assert held.count() < plain.count() // 10
    assert [r.id for r in table.orderBy("number").collect()] == sorted(r[0] for r in rows)


def test_an_empty_table_has_an_index(spark, tmp_path):
    textindex.build(spark.createDataFrame([], "id int, title string"), ["title"], str(tmp_path), ["id"])
    assert textindex.search(spark, str(tmp_path), "needle").rows.count() == 0


def test_runs_of_texts_and_many_characters():
    import numpy as np

    assert textindex._runs(np.array([3, 4, 5, 1 << 33, (1 << 33) + 40000, 2]), np.array([1, 5 << 20, 1, 1, 1, 1])) == [(0, 1), (1, 2), (2, 3), (3, 4), (4, 5), (5, 6)]
    assert textindex._runs(np.arange(0), np.arange(0)) == [] and textindex._runs(np.arange(9), np.ones(9)) == [(0, 9)]
    many = "".join(chr(k) for k in (*range(0x20, 0xD800), *range(0x10000, 0x90000)))
    texts = ["", "ab", "a\0\0\0", many, "aaaa", many[5:900] * 2, "é\U0001f600x"]
    found = [x for grams, at in textindex._held(texts) for x in zip(textindex._utf8(grams).to_pylist(), at.tolist(), strict=True)]
    assert sorted(found) == sorted({(t[i : i + 3], k) for k, t in enumerate(texts) for i in range(len(t) - 2)})


def test_trigrams(spark):
    rows = spark.createDataFrame([("aBcab",), ("é\U0001f600x",), ("ab",), ("",), (None,)], "t string").select(textindex.trigrams(F.col("t")).alias("g")).collect()
    assert [sorted(r.g) for r in rows] == [["abc", "bca", "cab"], ["é\U0001f600x"], [], [], []]


def test_pages(spark, tmp_path):
    rng = random.Random(5)
    rows = [(k, f"n{rng.randrange(50)}-{rng.randrange(12)}") for k in range(233)]
    df = spark.createDataFrame(rows, "id int, label string").repartition(4)
    for descending in (False, True):
        path = str(tmp_path / f"p{descending}")
        assert pages.store(df, path, pages.natural("label", descending, ["id"]), 10, folder_pages=3) == 24
        want = explore.naturally_sorted(df, "label", descending, ["id"]).collect()
        for number in (0, 2, 3, 23, 24, 1000, -1):
            at = max(0, min(number, 23))
            got = pages.page(spark, path, number).orderBy("number").collect()
            assert [(r.id, r.label, r.number) for r in got] == [(r.id, r.label, at * 10 + k + 1) for k, r in enumerate(want[at * 10 : at * 10 + 10])]
    plan = pages.page(spark, path, 5)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(folder" in plan and "GreaterThanOrEqual(number" in plan and "Sort" not in plan
    assert pages.store(df.where("id < 0"), str(tmp_path / "none"), pages.natural("label"), 10) == 1
    assert pages.page(spark, str(tmp_path / "none"), 0).count() == 0
