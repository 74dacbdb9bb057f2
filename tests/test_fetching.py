"""Fetching that survives lost tasks and runs that break off."""

from __future__ import annotations

import json
import os
import subprocess
import sys
import textwrap
from collections import Counter
from pathlib import Path

import pytest

from arborlit.plans import programs
from arborlit.sources import readers, remote

ROOT = str(Path(__file__).resolve().parent.parent)


def service(calls: Path, broken: set[str] = frozenset()):
    """Answers every id, leaves a file for each call, and ends its process where a call holds a broken id for the first time."""

    def fetch(ids):
        (calls / f"{ids[0]}-{os.getpid()}-{os.urandom(4).hex()}").write_text(",".join(ids))
        for x in broken & set(ids):
            if not (calls / f"fell-{x}").exists():
                (calls / f"fell-{x}").write_text("")
                os._exit(9)
        return json.dumps([{"pmid": x, "id": x} for x in ids if not x.endswith("9")])

    return fetch


def called(calls: Path) -> Counter:
    return Counter(x for f in calls.iterdir() if not f.name.startswith("fell-") for x in f.read_text().split(","))


def test_a_run_that_breaks_off_leaves_what_its_tasks_fetched(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    ids = [f"{k:03d}" for k in range(200)]
    search = spark.createDataFrame([(x, "t", "j", k) for k, x in enumerate(ids)], "pmid string, title_e string, journal string, ord int")
    cache, out = str(tmp_path / "cache"), str(tmp_path / "out")
    with pytest.raises(Exception, match="Python worker"):  # here a task has one attempt, so its job ends with it
        programs.fetch_documents(spark, search, cache, out, service(calls, {"150"}), batch=5, every=2, tries=1)
    left = {r.pmid for r in remote.logged(spark, f"{cache}.log").where("record is not null").collect()}
    assert left and not left & {"150", "151", "152", "153", "154"}
    status = programs.fetch_documents(spark, search, cache, out, service(calls, {"150"}), batch=5, every=2, tries=1).first()
    assert (status.ok, status.failed, status.total) == (180, 20, 200)
    n = called(calls)
    assert all(n[x] == 1 for x in left)  # nothing that a task has finished is asked for again
    assert not readers.exists(spark, f"{cache}.log")
    assert sorted(r.pmid for r in readers.cached_records(spark, cache).collect()) == [x for x in ids if not x.endswith("9")]


def test_a_lost_task_repeats_its_own_batches_only(tmp_path):
    """With several attempts a task, the job goes on; counted by calls."""
    calls = tmp_path / "calls"
    calls.mkdir()
    code = f"""
        import sys
        sys.path[:0] = [{ROOT!r}, {ROOT + "/tests"!r}]
        from pathlib import Path
        from pyspark.sql import SparkSession
        from arborlit.sources import remote
        from test_fetching import service
        spark = SparkSession.builder.master("local[3,4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", {str(tmp_path / "c")!r}).getOrCreate()
        ids = spark.createDataFrame([(f"{{k:03d}}",) for k in range(120)], "pmid string")
        remote.fetch_into({str(tmp_path / "log")!r}, ids, service(Path({str(calls)!r}), {{"037", "081"}}), batch=5, every=2, tries=1)
        rows = remote.logged(spark, {str(tmp_path / "log")!r}).collect()
        assert len(rows) == 120 and sum(r.record is None for r in rows) == 12
    """
    env = os.environ | {"PYTHONPATH": f"{ROOT}:{ROOT}/tests"}
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    n = called(calls)
    assert set(n) == {f"{k:03d}" for k in range(120)}
    assert 0 < sum(v > 1 for v in n.values()) <= 2 * 2 * 5 * 2 and n["000"] == 1  # the two tasks' batches, of 10 ids each but for how ranges fall


def test_answers_on_record(spark):
    rows = [("a", ["1", "2"], 200, json.dumps({readers.WRAPPER: [{"pmid": "1", "journal": "J"}]})), ("b", ["3"], 503, None), ("c", ["4"], 200, " "), ("d", ["5"], 200, json.dumps([{"id": "5"}])), ("e", ["3", "2"], 200, json.dumps({"pmid": "3"})), ("f", ["7"], 200, "{")]
    responses = spark.createDataFrame(rows, "request string, ids array<string>, status int, body string")
    ids = spark.createDataFrame([(x,) for x in "123456"] + [("1",)], "pmid string")
    got = {r.pmid: (r.record is not None, r.reason) for r in remote.recorded_records(ids, responses).collect()}
    assert got == {"1": (True, ""), "2": (False, "absent_from_response"), "3": (True, ""), "4": (False, "no_record"), "5": (True, ""), "6": (False, "absent_from_response")}
    values = remote.recorded_values(ids.toDF("key"), spark.createDataFrame([("1", '{"n": 4}'), ("2", None), ("9", "{}")], "key string, raw string"), "STRUCT<n: INT>")
    assert {r.key: r.value and r.value.n for r in values.collect()} == {"1": 4, "2": None}
