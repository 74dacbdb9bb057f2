"""Personal data: the four forms against plain expressions, the graph against plain loops."""

from __future__ import annotations

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import pytest

from arborlit.llm import pii, queries

from tests.llm.test_text_operators import SCHEMA, base_rows

FORMS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain_base(text):
    out = []
    for kind, form in enumerate(FORMS):
        for m in re.finditer(form, text):
            digits = [int(c) for c in m[0] if c.isascii() and c.isdigit()]
            if kind == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == 2:
                doubled = [d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits))]
                if not 13 <= len(digits) <= 19 or sum(doubled) % 10:
                    continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def test_forms_match_plain_expressions():
    rng = random.Random(1)
    for alphabet in ("ab@.-1 ", "0123.", "+1 ()-.9", "01 -", "0123456789 -", "a@b.c\n_%+é²٣ ", "25.60 +@a-"):
        for _ in range(3000):
            text = "".join(rng.choices(alphabet, k=rng.randrange(60)))
            assert pii.base_spans(text) == plain_base(text), repr(text)
    for text in ("4111 1111-1111 1111", "x4111111111111111y", "0000001.002.0003.255", "+49 (30) 1234-567 ) +1 2", "a@b.c@d.e", "@a.b", "a.@-.-", "1.2.3.4.5.6.7.8.9"):
        assert pii.base_spans(text) == plain_base(text), text


@pytest.mark.parametrize("text", ["a" * 2_000_000, "@" * 500_000, "a@" * 300_000, "1" * 2_000_000, "1.2." * 400_000, "1 " * 500_000, "+1(" * 400_000, "(at" * 400_000, "a@b" * 300_000, "+1" + " " * 1_000_000])
def test_hostile_texts_take_linear_time(text):
    began = time.process_time()
    base = pii.base_spans(text)
    assert len(pii.candidates(text, base)) >= 0
    assert time.process_time() - began < 10


def contact_rows():
    rng = random.Random(2)
    rows = [f"For help please write to u{k}.x{rng.randrange(99)}@mail{k}.example.com today" for k in range(8)]
    rows += [f"please call +1 (5{k}) 555-01{k} now" for k in range(10, 50)]
    rows += [f"the host at 10.0.{k}.{k * 7} was seen in log {k}" for k in range(6)]
    unseen = ["For help please write to jane(at)example.org today", "please call (030) 555-0199 now", "the host at fe80:0:0:1 was seen"]
    # trusted only through what the pattern above has found: nobody's seed stands behind "ring"
    chain = ["please call 030 777 01%d now" % k for k in range(10, 22)] + ["you may ring 030 777 01%d" % k for k in range(10, 22)] + ["you may ring 040 888 0001"]
    clean = ["section 1234 of the 5678 rules", "the year 1999 and 2001", "in 2001 the 300 men", "version 1.2.3 was out"]
    return rows + unseen + chain + clean + [None, "", "only words here"], unseen, chain, clean


def added_texts(found, texts):
    return {texts[r.doc_id][s.start : s.end]: pii.KINDS[s.kind] for r in found for s in r.spans if s not in r.base}


def test_contexts_find_what_forms_do_not(spark):
    texts, unseen, chain, clean = contact_rows()
    rows = list(enumerate(texts))
    got = pii.find(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    added = added_texts(got, texts)
    assert added["jane(at)example.org"] == "email" and added["(030) 555-0199"] == "phone" and added["fe80:0:0:1"] == "ip"
    assert added["040 888 0001"] == "phone"  # in the third step only
    once = pii.find(spark.createDataFrame(rows, "doc_id long, text string"), pii.Bootstrap(rounds=1)).collect()
    assert "040 888 0001" not in added_texts(once, texts) and "030 777 0111" in added_texts(once, texts)
    for r in got:
        text = texts[r.doc_id] or ""
        assert [tuple(s) for s in r.base] == plain_base(text) and set(r.base) <= set(r.spans)
        assert [tuple(s) for s in r.spans] == sorted(map(tuple, r.spans))
        if text in clean or not text:
            assert r.spans == r.base == []


def plain_find(texts, how):
    """Scores by loops over dictionaries."""
    places, edges = [], {}
    for k, text in enumerate(texts):
        base = pii.base_spans(text or "")
        for kind, s, e in base:
            places.append((k, s, e, kind, 0))
        places += [(k, s, e, -1, pii.fits(text[s:e])) for s, e in (pii.candidates(text, base) if text else ())]
    for k, s, e, seed, shapes in places:
        for p in pii.patterns(texts[k], s, e, how.reach):
            old = edges.get((p, texts[k][s:e].lower()), (-1, 0))
            edges[p, texts[k][s:e].lower()] = (max(old[0], seed), max(old[1], shapes))
    of = defaultdict(list)
    for (p, i), (seed, shapes) in edges.items():
        of[p].append((i, seed, shapes))
    scores, trust = {}, {}
    for _ in range(how.rounds):
        trust = {}
        for p, held in of.items():
            for kind in range(4):
                s = [pii.ONE if seed == kind else scores.get((i, kind), 0) if seed < 0 else 0 for i, seed, _ in held]
                t = sum(s) // (len(held) + 1)
                if sum(x >= how.trust for x in s) >= how.support and t >= how.trust:
                    trust[p, kind] = t
        scores = {}
        for p, held in of.items():
            for i, seed, shapes in held:
                for kind in range(4):
                    if seed < 0 and shapes >> kind & 1 and (p, kind) in trust:
                        scores[i, kind] = max(scores.get((i, kind), 0), trust[p, kind])
    out = defaultdict(list)
    for k, s, e, seed, shapes in places:
        if seed >= 0:
            out[k].append((seed, s, e))
            continue
        best = max(((trust.get((p, kind), 0), -kind) for p in pii.patterns(texts[k], s, e, how.reach) for kind in range(4) if shapes >> kind & 1), default=(0, 0))
        if best[0] > 0:
            out[k].append((-best[1], s, e))
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("how", [pii.Bootstrap(), pii.Bootstrap(rounds=2, trust=300_000, support=2), pii.Bootstrap(rounds=4, trust=500_000, support=1, reach=12)])
def test_spans_are_those_of_plain_loops(spark, monkeypatch, how):
    rng = random.Random(3)
    words = ["call", "at", "to", "no.", "the", "id:", "(", "mail=", "\n"]
    things = ["4111111111111111", "+49 30 1234567", "030 1234567", "10.1.2.3", "a@b.co", "a(at)b", "12", "1999", "4111111111111112", "::1", "x9", "030-99-88-77", "fe80::1:2"]
    made = [" ".join(rng.choice(words) if rng.random() < 0.6 else rng.choice(things) for _ in range(30)) for _ in range(60)]
    texts = made + contact_rows()[0] + [t for _, t, *_ in base_rows()]
    expected = plain_find(texts, how)
    assert any(len(v) > len(plain_base(texts[k])) for k, v in expected.items())
    monkeypatch.setattr(pii, "CHUNK", 4)
    docs = spark.createDataFrame([(k, t, "c", 1) for k, t in enumerate(texts)], "doc_id long, text string, spans string, row int").repartition(5)
    got = pii.find(docs, how).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(texts)))
    assert {r.doc_id: [tuple(s) for s in r.spans] for r in got if r.spans} == expected


def test_repeats_nulls_and_nothing(spark):
    rows = [(1, "mail a@b.co", "s", 1, 2, 3, "r", 4, 5)] * 3 + [(None, "mail a@b.co", "s", 1, 2, 3, "r", 4, 5), (1, None, None, 1, 2, 3, "r", 4, 5), (1, "mail c(at)d", None, 1, 2, 3, "r", 4, 5)]
    got = Counter((r.doc_id, tuple(map(tuple, r.spans))) for r in pii.find(spark.createDataFrame(rows, SCHEMA)).collect())
    hit = ((0, 5, 11),)
    assert got == Counter({(1, hit): 3, (None, hit): 1, (1, ()): 2})  # repeats of one address don't make a pattern
    assert pii.find(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query(spark, sf_small):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    got = queries.op11_personal_data(spark, sf_small).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        base = plain_base(docs[r.doc_id])
        told = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[0] == k for x in base) for k in range(4)]
        assert set(told.split(",")) - {""} <= set(r.spans.split(","))
