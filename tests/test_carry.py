"""Values carried down an order, across the edges of ranges."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from arborlit.operators.carry import carry_down
from arborlit.sources import readers


@pytest.mark.parametrize("parts", [1, 4, 13])
def test_carry_down(spark, parts):
    rng = random.Random(parts)
    rows = [(k, rng.choice([None, None, None, f"a{k}"]), rng.choice([None] * 40 + [f"b{k}"])) for k in range(200)]
    expected, a, b = [], None, None
    for k, x, y in rows:
        a, b = x or a, y or b
        expected.append((k, a, b))
    df = spark.createDataFrame(rows, "k int, x string, y string").repartition(5)
    got = carry_down(df, {"a": F.col("x"), "b": F.col("y")}, ["k"], parts).orderBy("k").collect()
    assert [(r.k, r.a, r.b) for r in got] == expected
    assert carry_down(df.where("k < 0"), {"a": F.col("x")}, ["k"]).count() == 0


def test_outline_in_many_files(spark, tmp_path):
    """Headings hold on over files and ranges; an A without B forgets the B before it."""
    lines, expected = [], []
    for a in range(6):
        lines.append(f"A<b>Top {a}</b>")
        if a == 3:
            lines.append(f"C    {90000 + a} direct [PATH:x]")
            expected.append((str(90000 + a), [f"Top {a}", "direct"]))
        for b in range(4):
            lines += [f"B  Mid {a}{b}", "B"]
            for c in range(30):
                number = f"{a * 1000 + b * 100 + c:05d}"
                lines.append(f"C    {number} Leaf {number} [PATH:hsa{number}]")
                expected.append((number, [f"Top {a}", f"Mid {a}{b}", f"Leaf {number}"]))
    for k in range(0, len(lines), 100):
        (tmp_path / f"part-{k:05d}.txt").write_text("\n".join(lines[k : k + 100]) + "\n")
    got = readers.pathway_outline(spark, str(tmp_path)).collect()
    assert sorted((r.class_id, r.path_parts) for r in got) == sorted(expected)
