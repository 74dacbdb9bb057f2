"""Scalar functions on golden rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from arborlit.functions import text as X


def apply(spark, f, values, kind="string"):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {kind}")
    return [r.out for r in rows.select("k", f(F.col("v")).alias("out")).orderBy("k").collect()]


def test_clean_number(spark):
    assert apply(spark, X.clean_number, [None, "", " 2021.0 ", "NaN", "nan", "5", "1.05", "\t7\n"]) == ["", "", "2021", "", "", "5", "1.05", "7"]


JOURNALS = {
    None: ("", "", "", ""),
    "": ("", "", "", ""),
    "J Med 2020 suppl": ("2020", "2020", "", ""),
    "no year": ("", "", "", ""),
    "J Med. Abbr; 2021 Mar 5;12:3. doi: 10.1/x": ("20210305", "2021", "03", "05"),
    "J; 2021 Mar": ("20210301", "2021", "03", "01"),
    "J; 2021 Mar 12. doi:10": ("20210312", "2021", "03", "12"),
    "J; 2021 Mar 123": ("20210301", "2021", "03", "01"),
    "J; 2021 March 5": ("", "", "", ""),
    "J; 2021-04-09 PMID: 1": ("20210409", "2021", "04", "09"),
    "J; 202104": ("202104", "2021", "04", "01"),
    "J; 2019;8": ("2019", "2019", "01", "01"),
    "J; 123": ("", "", "", ""),
    "J; ": ("", "", "", ""),
    "J; 20210409123 x": ("20210409", "2021", "04", "09"),
}


def test_journal_date(spark):
    assert [tuple(x) for x in apply(spark, X.journal_date, list(JOURNALS))] == list(JOURNALS.values())


def test_record_date(spark):
    got = apply(spark, X.record_date, ["2021-03-05T00:00:00Z", " 2021-99-99", "1899-01-01", None, "2021-3-5"])
    assert [x and tuple(x) for x in got] == [("20210305", "2021", "03", "05"), ("20219999", "2021", "99", "99"), None, None, None]


@pytest.mark.parametrize(
    ("f", "pairs"),
    [
        (X.zero_pad, {"1": "01", "12": "12", "123": "123", "": "00"}),
        (X.strip_prefix, {"MESH:D01": "D01", "D01": "D01", "a:b:c": "b:c", None: "", " x ": "x"}),
        (X.leaf, {"a.b.c": "c", "a": "a", "": ""}),
        (X.top_level, {"a.b.c": "a", "a": "a"}),
        (X.slug, {"Diseases": "diseases", "Chemicals and Drugs": "chemicals", "Technology, Industry, Agriculture": "technology_industry_agriculture"}),
        (X.bucket, {"Anatomy.x": "other", "Diseases.x": "Diseases", "Humanities": "Humanities", "": ""}),
        (X.strip_tags, {"<b>Top</b>": "Top"}),
        (X.strip_trailing_note, {"Name [PATH:x] ": "Name", "a [b] c": "a [b] c"}),
        (X.id_tail, {"https://x/S1": "S1", "S2": "S2"}),
        (lambda c: X.strip_organism(c, "hsa"), {"hsa:672": "672", "mmu:1": "mmu:1"}),
        (X.journal_head, {"J; 2021": "J", None: ""}),
        (X.short_label, {"x" * 38: "x" * 38, "y" * 39: "y" * 37 + "…"}),
        (X.count_value, {"12": 12, "": 0, None: 0, "x": 0}),
        (X.top_level_name, {"C14.280": "Diseases", "Y1": None, "D02": "Chemicals and Drugs"}),
        (X.is_term_id, {"D000001": True, "C123456789": True, "D12": False, "OMIM1": False, None: False}),
        (X.title_or_default, {"": "(untitled)", None: "(untitled)", "t": "t"}),
    ],
)
def test_scalars(spark, f, pairs):
    assert apply(spark, f, list(pairs)) == list(pairs.values())


def test_gene_ids(spark):
    got = apply(spark, X.split_gene_ids, ["Gene:672;675", "672, 675", "none", None, "7:8", ";;9", "None;1"])
    assert got == [["672", "675"], ["672", "675"], [], [], ["7:8"], ["9"], ["1"]]


def test_lists(spark):
    assert apply(spark, X.subjects_list, ["a | b | ", None, " | ", "x"]) == [["a", "b"], [], [], ["x"]]
    assert apply(spark, X.subjects_text, [["a", "b"], [], ["x"]], "array<string>") == ["a | b | ", "", "x | "]
    assert apply(spark, X.prefixes, [["a", "b"], []], "array<string>") == [[["a"], ["a", "b"]], []]
    assert apply(spark, X.drop_repeats, [["a", "a", "b", "a"], []], "array<string>") == [["a", "b", "a"], []]


def test_doi(spark):
    f = lambda c: X.doi(F.lit(""), F.lit(None).cast("string"), c)
    assert apply(spark, f, ["J; x. DOI: 10.1/ab;c", None, "none"]) == ["10.1/ab", "", ""]


def test_shown_date(spark):
    rows = spark.createDataFrame([("2021", "3", "5"), ("2021", "", "5"), ("", "3", "5"), ("2021", "03", None)], "y string, m string, d string")
    assert [r[0] for r in rows.select(X.shown_date(F.col("y"), F.col("m"), F.col("d"))).collect()] == ["2021-03-05", "2021-05", "", "2021-03"]


def test_natural_order_and_search(spark):
    rows = spark.createDataFrame([("a10",), ("a2",), ("A1",), ("b",), ("a02x",), (None,)], "v string")
    assert [r.v for r in rows.orderBy(X.natural_key("v")).collect()] == [None, "A1", "a2", "a02x", "a10", "b"]
    odd = spark.createDataFrame([("50%_x", "q"), ("500x", "Q%")], "a string, b string")
    assert odd.where(X.matches_query(" %_ ", ["a", "b"])).count() == 1
    assert odd.where(X.matches_query("q", ["b"])).count() == 2
    assert odd.where(X.matches_query("  ", ["a"])).count() == 2
