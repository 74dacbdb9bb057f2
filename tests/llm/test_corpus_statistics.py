"""Resampling and collocations against plain loops, with awkward rows."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from arborlit.llm import collocations, importance, ranking
from pyspark.sql import functions as F

from tests.llm.test_text_operators import SCHEMA, base_rows

LOWER = {c: c + 32 for c in range(65, 91)}


def test_positions(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"), F.lit(1).alias("position_of"))
    got = ranking.positions(df.repartition(7), [F.col("x").desc()]).collect()
    assert sorted((r.position, r.x) for r in got) == [(k + 1, 999 - k) for k in range(1000)]
    assert ranking.positions(df.where("x < 0"), [F.col("x")]).count() == 0


def grams(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(w), [" ".join(w[k : k + n]) for n in (1, 2, 3) for k in range(len(w) - n + 1)]


def plain_resample(rows, target, percent, least, buckets):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(bucket, grams(text)[1]))
    for text in target:
        t.update(map(bucket, grams(text)[1]))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    out = []
    for doc_id, text in rows:
        n, found = grams(text)
        weight = sum(gain[bucket(f)] for f in found)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= least))
    able = sorted((x for x in out if x[4]), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    drawn = able[: percent * len(able) // 100]
    return Counter(x[:4] for x in out), [x[:4] for x in drawn]


@pytest.mark.parametrize(("percent", "buckets"), [(5, 10_000), (60, 64)])
def test_resampling(spark, percent, buckets):
    rows = [*base_rows(), (77, "ÄÖ Éa\u0085b\x7fC-d_E\n42 " * 9, None, 1, 2, 3, "r", 4, 5)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"bucket": F.lit("b"), "rank": F.lit(1), "words": F.lit("w")}).repartition(3)
    target = spark.createDataFrame([("a1 a2 a3 été",), (None,), ("N8 n16",)], "text string")
    got = importance.resample(docs, target, percent=percent, buckets=buckets).collect()
    every, drawn = plain_resample([r[:2] for r in rows], [r.text for r in target.collect()], percent, 20, buckets)
    assert Counter(tuple(r)[:4] for r in got) == every
    ranked = sorted((r["rank"], tuple(r)[:4]) for r in got if r["rank"] is not None)
    assert [k for k, _ in ranked] == list(range(1, len(drawn) + 1)) and [x for _, x in ranked] == drawn


def test_resampling_nothing(spark):
    nothing, one = spark.createDataFrame([], SCHEMA), spark.createDataFrame([("a b",)], "text string")
    assert importance.resample(nothing, one).count() == 0
    docs = spark.createDataFrame([(1, "x y z " * 10), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in importance.resample(docs, one.where("false"), percent=100).collect()}
    assert got[1]["rank"] == 1 and got[2]["rank"] is None and got[2].weight == 0 and got[2].n_features == 0


def plain_collocations(rows, least, longest, cover, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[k : k + m])) for m in range(1, longest + 1) for k in range(len(w) - m + 1))
    f = {k: v for k, v in f.items() if v >= least}
    found = []
    for (lang, p), a in f.items():
        if len(p) > 1:
            score, k = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
            longer = [c for (g, q), c in f.items() if g == lang and len(q) > len(p) and any(q[j : j + len(p)] == p for j in range(len(q)))]
            if not any(100 * c >= cover * a for c in longer):
                found.append((lang, " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
    out = []
    for lang in n:
        ordered = sorted((x for x in found if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))
        out += [(x[0], k + 1, *x[1:]) for k, x in enumerate(ordered[:top])]
    return sorted(out)


def texts_with_phrases():
    text = "New York, new york city is a big  city\tin new york state. The the the the; big city IN. Été à été\x0bà la"
    rows = [("en", text)] * 4 + [(None, text + " new\nyork a big city")] * 3 + [("und", "a big city"), ("fr", "été à la mode " * 9), ("fr", None), ("", ""), ("x\ny", "a b " * 5), ("en", "  \x00b \x00b \x00b,\x00b " * 3)]
    return rows + [("de", " ".join(f"w{k * k % 11}" for k in range(3000)))]


@pytest.mark.parametrize(("least", "longest", "cover", "top", "bits"), [(3, 4, 80, 2000, 26), (3, 4, 80, 2000, 6), (2, 3, 50, 5, 8), (30, 4, 80, 7, 12)])
def test_collocations(spark, least, longest, cover, top, bits):
    """Also with bitmaps so small that they let everything through."""
    rows = texts_with_phrases()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, text string, n long, phrase string").repartition(3)
    got = collocations.collocations(docs, least, longest, cover, top, bits)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain_collocations(rows, least, longest, cover, top)


def test_collocations_of_many_blocks(spark, monkeypatch):
    """Counts of several blocks and tasks meet; nulls, no rows, and no words."""
    rows = texts_with_phrases()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(2)
    monkeypatch.setattr(collocations, "FLUSH_BYTES", 200)
    assert sorted(map(tuple, collocations.collocations(docs, 3).collect())) == plain_collocations(rows, 3, 4, 80, 2000)
    assert collocations.collocations(docs.where("false")).count() == 0
    assert collocations.collocations(spark.createDataFrame([(None, None), (None, ".,"), ("en", "")], "lang string, text string")).count() == 0


def test_large_counts_score_exactly(spark):
    """Products beyond 64 bits."""
    big = 3 * 10**17
    rows = [("en", "a", 1, big + 1), ("en", "b", 1, big + 7), ("en", "a b", 2, big)]
    got = collocations.scored(spark.createDataFrame(rows, "lang string, phrase string, width int, f long")).first()
    assert got.score == 2_000_000 * big // (2 * big + 8) and (got.l, got.r) == (big + 1, big + 7)
    kept = collocations.kept(spark.createDataFrame([("en", "a b", 2, 10**18), ("en", "a b c", 3, 8 * 10**17 - 1)], "lang string, phrase string, width int, a long"))
    assert kept.count() == 2


def test_filters_leave_out_rare_phrases(spark):
    """Later passes count hardly more than what is frequent: the bitmaps prune."""
    docs = spark.createDataFrame([("en", " ".join(f"r{k}_{j} often seen" for j in range(40))) for k in range(50)], "lang string, text string")
    first = collocations.count_pass(docs, 1, 4, collocations.Filters({}, {}), 30, 20)
    filters = collocations.Filters({2: collocations.collected(first, collocations.FULL, 20)}, {1: collocations.collected(first, collocations.FREQUENT, 20)})
    block = collocations.Block(["en"], collocations.np.frombuffer(b"often seen r1_1 often seen", dtype="u1"), collocations.np.array([0, 26]))
    text = collocations.read(block, [b"en"])
    assert filters.may_be_frequent(text, 2).tolist() == [True, False, False, True]
