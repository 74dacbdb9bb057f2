"""Scalar functions as column expressions; blank and null mean the same, "no value"."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names as they occur in journal citations.
MONTHS = (("Jan", "01"), ("Feb", "02"), ("Mar", "03"), ("Apr", "04"), ("May", "05"), ("Jun", "06"), ("Jul", "07"), ("Aug", "08"), ("Sep", "09"), ("Oct", "10"), ("Nov", "11"), ("Dec", "12"))

# The vocabulary's top-level categories by the first letter of a tree number.
TOP_LEVEL = {
    "A": "Anatomy",
    "B": "Organisms",
    "C": "Diseases",
    "D": "Chemicals and Drugs",
    "E": "Analytical, Diagnostic and Therapeutic Techniques and Equipment",
    "F": "Psychiatry and Psychology",
    "G": "Phenomena and Processes",
    "H": "Disciplines and Occupations",
    "I": "Anthropology, Education, Sociology and Social Phenomena",
    "J": "Technology, Industry, Agriculture",
    "K": "Humanities",
    "L": "Information Science",
    "M": "Named Groups",
    "N": "Health Care",
    "V": "Publication Characteristics",
    "Z": "Geographicals",
}

# Top-level categories that share the bucket "other", and short names of buckets.
LUMPED = (
    "Analytical, Diagnostic and Therapeutic Techniques and Equipment",
    "Anatomy",
    "Health Care",
    "Organisms",
    "Phenomena and Processes",
    "Psychiatry and Psychology",
    "Technology, Industry, Agriculture",
)
SLUGS = {"Chemicals and Drugs": "chemicals", "Diseases": "diseases"}

TERM_ID = r"^[CD]\d{6,9}$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of(value)`` with ``value`` computed once, however often ``of`` uses it."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def strip(c: Column | str) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(col(c), r"^\s+|\s+$", "")


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


def first_filled(*cols: Column | str) -> Column:
    """The first value that is neither null nor blank, else blank."""
    return F.coalesce(*map(blank_to_null, cols), F.lit(""))


def clean_number(c: Column | str) -> Column:
    """Stripped, without a trailing ``.0``; null and ``nan`` in any case become blank."""
    text = strip(F.coalesce(col(c).cast("string"), F.lit("")))
    return F.when(F.lower(text) == "nan", F.lit("")).otherwise(F.regexp_replace(text, r"\.0$", ""))


def zero_pad(c: Column, width: int = 2) -> Column:
    """Zeros before a shorter value; longer ones stay whole."""
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def date_parts(date: Column, year: Column, month: Column, day: Column) -> Column:
    return F.struct(date.alias("date"), year.alias("year"), month.alias("month"), day.alias("day"))


def journal_date(journal: Column | str) -> Column:
    """struct(date, year, month, day) of strings from a citation such as ``J Med; 2021 Mar 5;12:3. doi: 10.1/x``.

    Without a semicolon only a year is looked for.  Else the part after the first
    one counts, up to ``. ``, `` doi:`` or `` PMID:``: a year and a month name, with
    a day or 01; failing that, its digits, month names taken as numbers: 8 or more
    are a date, 6 a year and month, 4 a year; any other number gives nothing.
    """
    journal = F.coalesce(col(journal), F.lit(""))
    blank = F.lit("")
    year = F.regexp_extract(journal, r"\b((?:19|20)\d{2})\b", 1)
    raw = strip(F.substring_index(F.substring_index(journal, ";", 2), ";", -1))
    for end in (". ", " doi:", " PMID:"):
        raw = strip(F.substring_index(raw, end, 1))
    named = rf"\b((?:19|20)\d{{2}})\s*({'|'.join(m for m, _ in MONTHS)})\s*(\d{{1,2}})?\b"
    number = F.create_map(*(F.lit(x) for pair in MONTHS for x in pair))

    def by_name(raw: Column) -> Column:
        y, m, d = (F.regexp_extract(raw, named, k) for k in (1, 2, 3))
        month, day = F.try_element_at(number, m), F.when(d == "", F.lit("01")).otherwise(zero_pad(d))
        return F.when(y != "", date_parts(F.concat(y, month, day), y, month, day))

    def by_digits(digits: Column) -> Column:
        n = F.length(digits)
        cut = lambda at: F.when(n >= at + 1, F.substring(digits, at, 2)).otherwise(F.lit("01"))
        return F.when(n.isin(4, 6) | (n >= 8), date_parts(F.substring(digits, 1, 8), F.substring(digits, 1, 4), cut(5), cut(7)))

    def plain(raw: Column) -> Column:
        return F.regexp_replace(reduce(lambda out, x: F.replace(out, F.lit(x[0]), F.lit(x[1])), MONTHS, raw), "[^0-9]", "")

    none = date_parts(blank, blank, blank, blank)
    late = let(raw, lambda r: F.coalesce(by_name(r), let(plain(r), by_digits), none))
    return F.when(F.instr(journal, ";") == 0, let(year, lambda y: date_parts(y, y, blank, blank))).otherwise(late)


def record_date(value: Column | str) -> Column:
    """struct(date, year, month, day) from an ISO date at the start of a value, else null; the calendar isn't checked."""
    text = strip(F.coalesce(col(value).cast("string"), F.lit("")))
    y, m, d = (F.regexp_extract(text, r"^((?:19|20)\d{2})-(\d{2})-(\d{2})", k) for k in (1, 2, 3))
    return F.when(y != "", date_parts(F.concat(y, m, d), y, m, d))


def pick_date(previous: Column, record: Column, journal: Column, record_year: Column) -> Column:
    """The first date that there is; where it has no year, the record's."""
    chosen = F.coalesce(previous, record, journal)
    year = F.when(first_filled(chosen["year"]) == "", clean_number(record_year)).otherwise(chosen["year"])
    return date_parts(*(first_filled(x) for x in (chosen["date"], year, chosen["month"], chosen["day"])))


def join_filled(parts: list[Column], sep: str = "-") -> Column:
    """The values that aren't blank, joined."""
    return F.array_join(F.filter(F.array(*(F.coalesce(p, F.lit("")) for p in parts)), lambda x: x != ""), sep)


def shown_date(year: Column, month: Column, day: Column) -> Column:
    """``2021-03-05``, as far as known; blank without a year."""
    filled = lambda c: F.when(first_filled(c) != "", zero_pad(c)).otherwise(F.lit(""))
    return F.when(first_filled(year) == "", F.lit("")).otherwise(join_filled([year, filled(month), filled(day)]))


def doi(record_doi: Column, article_doi: Column, journal: Column) -> Column:
    return first_filled(record_doi, article_doi, F.regexp_extract(F.coalesce(journal, F.lit("")), r"(?i)doi:\s*([^;\s]+)", 1))


def strip_prefix(c: Column | str) -> Column:
    """What follows the first colon, stripped."""
    return strip(F.regexp_replace(F.coalesce(col(c), F.lit("")), "^[^:]*:", ""))


def split_gene_ids(c: Column | str) -> Column:
    """Ids separated by ``;`` or ``,``; a prefix up to a colon goes unless the value starts with a digit; blanks and ``none`` go."""
    raw = F.coalesce(col(c), F.lit(""))
    raw = F.when(raw.rlike("^[0-9]"), raw).otherwise(F.regexp_replace(raw, "^[^:]*:", ""))
    return F.filter(F.transform(F.split(raw, "[;,]"), strip), lambda x: (x != "") & (F.lower(x) != "none"))


def is_term_id(c: Column | str) -> Column:
    return F.coalesce(col(c).rlike(TERM_ID), F.lit(False))


def path_text(parts: Column | str) -> Column:
    return F.array_join(col(parts), ".")


def leaf(path: Column | str) -> Column:
    return F.substring_index(col(path), ".", -1)


def top_level(path: Column | str) -> Column:
    return F.substring_index(col(path), ".", 1)


def prefixes(parts: Column | str) -> Column:
    """All prefixes of a lineage, as arrays, shortest first."""
    parts = col(parts)
    return F.when(F.size(parts) > 0, F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.slice(parts, 1, n))).otherwise(F.array().cast("array<array<string>>"))


def subjects_text(names: Column | str) -> Column:
    """``a | b | `` with the separator at the end too; blank without names."""
    return F.when(F.size(col(names)) > 0, F.concat(F.array_join(col(names), " | "), F.lit(" | "))).otherwise(F.lit(""))


def subjects_list(text: Column | str) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(col(text), F.lit("")), r"\|"), strip), lambda x: x != "")


def slug(name: Column | str) -> Column:
    name = col(name)
    out = F.replace(F.replace(F.lower(name), F.lit(","), F.lit("")), F.lit(" "), F.lit("_"))
    return reduce(lambda x, kv: F.when(name == kv[0], F.lit(kv[1])).otherwise(x), SLUGS.items(), out)


def bucket(path: Column | str, split_all: bool = False, lumped: tuple[str, ...] = LUMPED) -> Column:
    """A path's top-level category, or ``other`` for the lumped ones."""
    top = top_level(path)
    return top if split_all else F.when(top.isin(*lumped), F.lit("other")).otherwise(top)


def top_level_name(tree_number: Column | str) -> Column:
    """The category of a tree number's first letter, null if there is none."""
    pairs = [F.lit(x) for kv in TOP_LEVEL.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), F.substring(col(tree_number), 1, 1))


def drop_repeats(parts: Column | str) -> Column:
    """Without values that equal the one just before them."""
    parts = col(parts)
    return F.filter(parts, lambda x, k: (k == 0) | (x != F.get(parts, k - 1)))


def strip_tags(c: Column | str) -> Column:
    return F.regexp_replace(col(c), "</?b>", "")


def strip_trailing_note(c: Column | str) -> Column:
    return strip(F.regexp_replace(col(c), r"\s*\[.*\]\s*$", ""))


def id_tail(c: Column | str) -> Column:
    return F.substring_index(col(c), "/", -1)


def strip_organism(c: Column | str, organism: str) -> Column:
    return F.when(col(c).startswith(f"{organism}:"), F.substring(col(c), len(organism) + 2, 1 << 30)).otherwise(col(c))


def doc_text(title: Column | str, abstract: Column | str) -> Column:
    return strip(F.concat(F.coalesce(col(title), F.lit("")), F.lit(" "), F.coalesce(col(abstract), F.lit(""))))


def journal_head(c: Column | str) -> Column:
    return F.substring_index(F.coalesce(col(c), F.lit("")), ";", 1)


def short_label(c: Column | str, most: int = 38) -> Column:
    return F.when(F.length(col(c)) > most, F.concat(F.substring(col(c), 1, most - 1), F.lit("…"))).otherwise(col(c))


def title_or_default(c: Column | str) -> Column:
    return F.coalesce(blank_to_null(c), F.lit("(untitled)"))


def document_url(pmid: Column | str) -> Column:
    return F.concat(F.lit("https://pubmed.ncbi.nlm.nih.gov/"), col(pmid), F.lit("/"))


def doi_url(value: Column | str) -> Column:
    return F.when(first_filled(value) != "", F.concat(F.lit("https://doi.org/"), col(value)))


def count_value(c: Column | str) -> Column:
    """A count held as text; blank counts as 0."""
    return F.coalesce(F.try_to_number(blank_to_null(F.regexp_extract(col(c).cast("string"), r"^\s*(\d+)\s*$", 1)), F.lit("9" * 18)).cast("long"), F.lit(0).cast("long"))


def file_label(pmid: Column | str) -> Column:
    return F.concat(col(pmid), F.lit("__.xml"))


def natural_key(c: Column | str, width: int = 20) -> Column:
    """A key that sorts digit runs by value: lower case, digits padded with zeros."""
    text = F.lower(F.coalesce(col(c).cast("string"), F.lit("")))
    pieces = F.regexp_extract_all(text, F.lit("([0-9]+|[^0-9]+)"), F.lit(1))
    padded = F.transform(pieces, lambda p: F.when(p.rlike("^[0-9]"), F.lpad(F.regexp_replace(p, "^0+(?=.)", ""), width, "0")).otherwise(p))
    return F.array_join(padded, "")


def matches_query(query: str | None, columns: list[str]) -> Column:
    """Whether any column contains the trimmed query, in any case; a blank query matches all."""
    wanted = (query or "").strip().lower()
    if not wanted:
        return F.lit(True)
    return reduce(or_, [F.lower(F.coalesce(F.col(c).cast("string"), F.lit(""))).contains(wanted) for c in columns])
