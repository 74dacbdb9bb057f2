"""Interval labels and additive distinct counts against plain sets."""

from __future__ import annotations

import random

import pytest

from arborlit.operators import intervals, rollup
from arborlit.sources.durable import durable


def deep_pairs(seed, n=400, depth=9):
    rng = random.Random(seed)
    names = ["a", "a-b", "a b", "B", "ä", "b"]  # sorting by whole paths would part these subtrees
    paths = [".".join(rng.choice(names) for _ in range(rng.randrange(1, depth))) for _ in range(60)]
    return [(rng.choice(paths), rng.choice([None, *range(25)])) for _ in range(n)]


def nodes_of(path):
    parts = path.split(".")
    return [".".join(parts[: k + 1]) for k in range(len(parts))]


@pytest.mark.parametrize("seed", [1, 2])
def test_labels_are_ranges(spark, seed):
    pairs = [*deep_pairs(seed), ("", 1), (None, 2)]
    got = {r.path: r for r in intervals.labels(spark.createDataFrame(pairs, "path string, pmid long").repartition(5)).collect()}
    assert set(got) == {n for p, _ in pairs if p for n in nodes_of(p)}
    assert sorted(r.low for r in got.values()) == list(range(1, len(got) + 1))
    for x in got.values():
        assert x.depth == len(x.path.split("."))
        for y in got.values():
            assert (y.low <= x.low <= y.high) == (y.path in nodes_of(x.path))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_distinct_counts_add_up(spark, seed):
    pairs = deep_pairs(seed)
    expected = {}
    for path, key in pairs:
        for n in nodes_of(path):
            expected.setdefault(n, set()).update({key} - {None})
    df = spark.createDataFrame(pairs, "path string, pmid long").repartition(5)
    held = durable(intervals.labels(df))
    got = {r.path: r.n for r in intervals.distinct_below(df, "pmid", held).collect()}
    assert got == {p: len(v) for p, v in expected.items() if v}
    genes = df.withColumnRenamed("pmid", "gene_id")
    rows = {r.path: r for r in rollup.hierarchy(genes, df).collect()}
    assert {p: (r.documents, r.genes) for p, r in rows.items()} == {p: (len(v), len(v)) for p, v in expected.items() if v}
    assert all(r.parent_path == r.path.rpartition(".")[0] and r.name == r.path.rpartition(".")[2] for r in rows.values())


def test_nothing_and_unknown_nodes(spark):
    none = spark.createDataFrame([], "path string, pmid long")
    held = durable(intervals.labels(none))
    assert held.count() == 0 and intervals.distinct_below(none, "pmid", held).count() == 0
    some = spark.createDataFrame([("a.b", 1)], "path string, pmid long")
    held = durable(intervals.labels(some))
    places = intervals.placed(some, held)
    assert [r.pmid for r in intervals.below(places, held, "a").collect()] == [1]
    assert intervals.below(places, held, "b").count() == 0


def test_a_range_is_read_by_the_scan(spark, tmp_path):
    pairs = [(f"a.{k // 100}.{k}", k) for k in range(3000)]
    df = spark.createDataFrame(pairs, "path string, pmid long")
    held = durable(intervals.labels(df))
    intervals.placed(df, held).orderBy("low").write.parquet(str(tmp_path / "p"))
    found = intervals.below(spark.read.parquet(str(tmp_path / "p")), held, "a.7")
    assert sorted(r.pmid for r in found.collect()) == list(range(700, 800))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(low" in plan and "LessThanOrEqual(low" in plan


def test_an_id_is_shuffled_once_a_path(spark):
    """However deep the hierarchy: rows after the exchange by id are those of the pairs."""
    df = spark.createDataFrame([(".".join("abcdefghij") + f".{k % 7}", k) for k in range(500)], "path string, pmid long")
    held = durable(intervals.labels(df))
    plan = intervals.distinct_below(df, "pmid", held)._jdf.queryExecution().optimizedPlan().toString()
    window = plan.index("Window")
    assert "Generate" not in plan[window:].split("chain")[0] and plan.count("Window") == 1
