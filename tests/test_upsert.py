"""The upserted table: versions by buckets, and what happens when one is missing."""

from __future__ import annotations

import random

import pytest

from arborlit.sources import sinks
from arborlit.streaming import upsert

SCHEMA = "k string, ord int, v string"


def state(spark, path, version=None):
    return {r.k: (r.ord, r.v) for r in upsert.latest_version(spark, path, version).collect()}


def test_batches_write_their_keys_buckets_only(spark, tmp_path):
    rng, target, held, states = random.Random(1), str(tmp_path / "t"), {}, []
    for number in range(5):
        rows = [(f"k{rng.randrange(400)}", rng.randrange(100), f"{number}-{j}") for j in range(300 if number == 0 else 4)]
        rows = list({(k, o): (k, o, v) for k, o, v in rows}.values())
        for k, o, v in rows:
            if k not in held or held[k][0] < o:
                held[k] = (o, v)
            elif held[k][0] == o:
                rows.remove((k, o, v))
        batch = spark.createDataFrame(rows, SCHEMA)
        upsert.merge_batch(batch, number, target, ["k"], ["ord"], 32)
        if number == 3:
            upsert.merge_batch(batch, number, target, ["k"], ["ord"], 32)  # run again after a failure
        assert state(spark, target) == held
        written = [b for b, v in upsert.manifest(spark, target, number).items() if v == number]
        assert len(written) <= len({r[0] for r in rows}) and (number == 0 or len(written) <= 4)
        states.append(dict(held))
    assert state(spark, target, 1) == states[1]
    upsert.merge_batch(spark.createDataFrame([], SCHEMA), 5, target, ["k"], ["ord"], 32)
    assert state(spark, target) == held
    assert upsert.tidy(spark, target, 1) > 0 and state(spark, target) == held
    with pytest.raises(FileNotFoundError):
        state(spark, target, 1)


def test_a_missing_version_is_an_error(spark, tmp_path):
    target, rows = str(tmp_path / "t"), spark.createDataFrame([("a", 1, "x")], SCHEMA)
    with pytest.raises(FileNotFoundError, match="version 4"):
        upsert.merge_batch(rows, 5, target, ["k"], ["ord"])
    upsert.merge_batch(rows, 0, target, ["k"], ["ord"])
    upsert.merge_batch(rows, 1, target, ["k"], ["ord"])
    with pytest.raises(ValueError, match="table of its own"):
        upsert.merge_batch(rows, 0, target, ["k"], ["ord"])
    sinks.remove(spark, f"{target}/manifest/version=1/_SUCCESS")  # a manifest that wasn't finished
    with pytest.raises(FileNotFoundError):
        upsert.merge_batch(rows, 2, target, ["k"], ["ord"])
    assert state(spark, target) == {"a": (1, "x")}
