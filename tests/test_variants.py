"""Records of unknown shape as variants."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from arborlit.sources import readers


def test_shapes_keep_every_field(spark):
    one, other = {"pmid": 7, "x": {"y": [1, None, "é"]}}, {"id": "b", "pmid": ""}
    bodies = [json.dumps({readers.WRAPPER: [one, other]}), json.dumps([other, one]), json.dumps(one), json.dumps({readers.WRAPPER: None}), json.dumps({readers.WRAPPER: "odd"}), "[]", "{", "", None, "3", '"text"', "null"]
    rows = spark.createDataFrame([(k, b) for k, b in enumerate(bodies)], "k int, body string")
    got = rows.select("k", F.posexplode(readers.response_variants(F.col("body"))).alias("n", "r")).select("k", "n", F.to_json("r").alias("json"), readers.variant_id(F.col("r")).alias("id"))
    assert {(r.k, r.n): (json.loads(r.json), r.id) for r in got.collect()} == {(0, 0): (one, "7"), (0, 1): (other, "b"), (1, 0): (other, "b"), (1, 1): (one, "7"), (2, 0): (one, "7")}


def test_cache_of_variants(spark, tmp_path):
    lines = ['{"pmid": "1", "record": {"id": "1", "new": {"a": 1}}}', "{bad", '{"pmid": "2", "record": {"id": "2"}}', '{"pmid": "1", "record": {"id": "1", "new": {"a": 2}, "journal": "J"}}', '{"pmid": "2", "record": null}', '{"pmid": "", "record": {}}', '{"record": {}}']
    (tmp_path / "c.jsonl").write_text("\n".join(lines) + "\n")
    got = readers.cached_variants(spark, str(tmp_path / "c.jsonl"))
    got.write.parquet(str(tmp_path / "p"))
    back = spark.read.parquet(str(tmp_path / "p"))
    rows = back.select("pmid", F.to_json("record").alias("json"), readers.as_record(F.col("record")).alias("s"), F.try_variant_get("record", "$.new.a", "int").alias("a")).collect()
    assert [(r.pmid, json.loads(r.json), r.s.journal, r.a) for r in rows] == [("1", {"id": "1", "new": {"a": 2}, "journal": "J"}, "J", 2)]
    assert readers.cached_variants(spark, str(tmp_path / "nothing")).count() == 0
