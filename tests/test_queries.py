"""Registered queries against SQL on the smallest driver data."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as driver
from arborlit.plans import queries as plans


@pytest.fixture(scope="module")
def con(sf_small):
    con = duckdb.connect()
    for f in os.listdir(sf_small):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{sf_small}/{f}')")
    return con


@pytest.mark.parametrize("name", sorted(plans.ORACLES))
def test_matches_sql(spark, sf_small, con, name):
    got, expected = plans.QUERIES[name](spark, sf_small).toPandas(), con.sql(plans.ORACLES[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(expected.columns)
    rows = lambda frame: Counter(map(tuple, frame[columns].astype(str).values.tolist()))
    assert rows(got) == rows(expected)


def test_model_query(spark, sf_small):
    got = plans.classify_quality(spark, sf_small)
    assert got.columns == ["pmid", "hard_category_predicted", "hard_category_predicted_confidence"]
    assert got.count() > 50


def test_model_query_trains_the_whole_model(spark, sf_small, monkeypatch):
    trained = []
    monkeypatch.setattr(plans.classify, "train", lambda *a, f=plans.classify.train, **k: trained.append(f(*a, **k)) or trained[-1])
    plans.classify_quality(spark, sf_small)
    stages = trained[0].model.stages
    words = next(s for s in stages if s.hasParam("minDF") and s.getOutputCol() == "__counts")
    logistic = next(s for s in stages if s.hasParam("regParam"))
    assert words.getVocabSize() == 8000 and 2000 < len(words.vocabulary) < 8000
    assert logistic.getMaxIter() == 2000 and 20 < logistic.summary.totalIterations < 2000


def test_entry(spark):
    assert driver.entry(spark).count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_mentions_join_broadcasts_the_dimension(spark, sf_small):
    plan = plans.tree_counts(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan
