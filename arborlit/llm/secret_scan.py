"""Secret scan: fixed patterns, and sliding-window entropy per character class.

Everything is built-in column expressions.  Positions come from splitting a text
by a pattern and laying the pieces and the matches end to end, in code points;
running sums go by blocks of about the square root of their number.  A text is
searched for assignments only if it holds one of their words, and once for long
runs of the widest character class; all other patterns can match within those only.

Candidates for the entropy rule are runs of one character class, whatever stands
next to them: hexadecimal, upper case with digits, lower case with digits, both
cases with digits, and the same with the signs of base 64.  Each class has its own
threshold: of random strings that are just one window long, about one in a hundred
stays below it.  A window slides over a candidate; the sum of c * log2(c) over its character counts
is carried along, and a step only changes the terms of the character that leaves
and the one that enters.  The window's entropy is log2(w) less that sum over w.
A candidate with a window at or above its class's threshold is reported from the
first such window to the last, unless the allow-list knows it; stretches of several
classes that overlap are reported as one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from math import log2
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the base rules, in the order in which kinds are listed.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "entropy")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
WIDEST = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}"
SPAN = "array<struct<start:int,kind:int,end:int>>"
RUN = "array<struct<start:int,kind:int,end:int,run:string>>"

# Strings that are known to be no secrets.
ALLOWED = (
    r"(?i)example",
    r"(?i)(xxxx|placeholder|changeme|dummy|your[_-]?(key|token))",
    r"(?i)^(0123456789abcdef)+",
    r"(?i)abcdefghijklmnop",
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    r"^[0-9]+$",
)


@dataclass(frozen=True)
class EntropyRule:
    """A character class: the runs that are candidates, what they must hold, the window and its threshold in bits."""

    candidate: str
    must: tuple[str, ...]
    window: int
    bits: float


RULES = (
    EntropyRule(r"[0-9a-fA-F]{20,}", ("[0-9]", "[a-fA-F]"), 20, 2.9),
    EntropyRule(r"[A-Z0-9]{20,}", ("[0-9]", "[A-Z]"), 20, 3.4),
    EntropyRule(r"[a-z0-9]{20,}", ("[0-9]", "[a-z]"), 20, 3.4),
    EntropyRule(r"[A-Za-z0-9]{20,}", ("[0-9]", "[A-Z]", "[a-z]"), 20, 3.6),
    EntropyRule(r"[A-Za-z0-9+/_=-]{20,}", ("[0-9]", "[A-Z]", "[a-z]"), 20, 3.6),
)


def matches(text: Column, pattern: str) -> Column:
    """All matches of ``pattern``, leftmost and non-overlapping."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``value``, which is evaluated once however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Running results of an associative ``combine`` (0 changes nothing) over an array of int.

    The array is cut into about as many blocks as a block is long, so that
    appending costs n**1.5, not n**2.
    """
    zero, none = F.lit(0), F.array().cast("array<int>")

    def along(block: Column) -> Column:
        return F.aggregate(block, none, lambda done, x: F.concat(done, F.array(combine(F.coalesce(F.try_element_at(done, F.lit(-1)), zero), x))))

    def whole(parts: Column) -> Column:
        ends = F.aggregate(parts, F.array(zero), lambda done, part: F.concat(done, F.array(combine(F.element_at(done, -1), F.element_at(part, -1)))))
        return F.flatten(F.zip_with(parts, F.slice(ends, 1, F.size(parts)), lambda part, before: F.transform(part, lambda x: combine(before, x))))

    def cut(held: Column) -> Column:
        size = F.greatest(F.ceil(F.sqrt(F.size(held))).cast("int"), F.lit(1))
        parts = bound(size, lambda n: F.transform(F.sequence(F.lit(0), F.size(held) - 1, n), lambda k: along(F.slice(held, k + 1, n))))
        return F.when(F.size(held) > 0, bound(parts, whole)).otherwise(none)

    return bound(values, cut)


def located(text: Column, pattern: str, found: Column, kind: int, keep: Callable[[Column], Column] | None = None) -> Column:
    """The matches ``found`` of ``pattern`` that pass ``keep``, a predicate of the matched string, as (start, kind, end, run)."""
    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(found))

    def spans(ends: Column) -> Column:
        each = F.zip_with(ends, found, lambda end, run: F.struct((end - F.length(run)).alias("start"), F.lit(kind).alias("kind"), end.alias("end"), run.alias("run")))
        return F.filter(each, lambda x: keep(x["run"])) if keep else each

    sizes = F.zip_with(gaps, found, lambda gap, run: F.length(gap) + F.length(run))
    none = F.array().cast(RUN)
    held = F.when(F.size(found) > 0, bound(bound(sizes, lambda n: running(n, lambda a, b: a + b)), spans)).otherwise(none)
    return F.when(F.exists(found, keep), held).otherwise(none) if keep else held


def inside(runs: Column, pattern: str, kind: int, keep: Callable[[Column], Column]) -> Column:
    """As :func:`located`, of the matches within ``runs``, in the text's positions."""

    def within(run: Column) -> Column:
        found = bound(matches(run["run"], pattern), lambda m: located(run["run"], pattern, m, kind, keep))
        return F.transform(found, lambda x: F.struct((x["start"] + run["start"]).alias("start"), x["kind"].alias("kind"), (x["end"] + run["start"]).alias("end"), x["run"].alias("run")))

    return F.when(F.size(runs) > 0, F.flatten(F.transform(runs, within))).otherwise(F.array().cast(RUN))


def bare(spans: Column) -> Column:
    """Spans without the matched strings."""
    return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")))


def _term(count: Column) -> Column:
    return F.when(count > 1, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))


def hot_window(run: Column, rule: EntropyRule) -> Column:
    """The first and last starts of windows of ``run`` whose entropy reaches the threshold: struct(low, high), low -1 if none."""

    def numbered(codes: Column) -> Column:
        """Characters as places in the run's own alphabet, so that counts are as few as it has characters."""
        return bound(F.array_distinct(codes), lambda alphabet: bound(F.transform(codes, lambda c: F.array_position(alphabet, c).cast("int")), lambda places: _hot_window(places, F.size(alphabet), rule)))

    return bound(F.transform(F.split(run, ""), F.ascii), numbered)


def _hot_window(codes: Column, size: Column, rule: EntropyRule) -> Column:
    """``codes``: from 1 to ``size``."""
    w = rule.window
    # counts of characters by code, and the sum of c * log2(c), of the first window
    first = F.slice(codes, 1, w)
    most = F.lit(w * (log2(w) - rule.bits) + 1e-9)
    begin = F.transform(F.sequence(F.lit(1), size), lambda c: F.size(F.filter(first, lambda x: x == c)))
    when_hot = lambda total: F.when(total <= most, 0).otherwise(-1)

    def slid(counts: Column) -> Column:
        total = F.aggregate(counts, F.lit(0.0), lambda s, c: s + _term(c))
        start = F.struct(counts.alias("counts"), total.alias("total"), when_hot(total).alias("low"), when_hot(total).alias("high"))

        def step(s: Column, k: Column) -> Column:
            """The window that begins at ``k`` (from 0); one character goes, one comes, and nothing is worked out twice."""
            return bound(F.struct(F.element_at(codes, k).alias("gone"), F.element_at(codes, k + w).alias("came")), lambda x: bound(changed(s, x), lambda t: told(s, x, t, k)))

        def changed(s: Column, x: Column) -> Column:
            n, m = F.element_at(s["counts"], x["gone"]), F.element_at(s["counts"], x["came"])
            return F.when(x["gone"] == x["came"], s["total"]).otherwise(s["total"] - _term(n) + _term(n - 1) - _term(m) + _term(m + 1))

        def told(s: Column, x: Column, total: Column, k: Column) -> Column:
            held = F.when(x["gone"] == x["came"], s["counts"]).otherwise(F.transform(s["counts"], lambda c, i: c - (i + 1 == x["gone"]).cast("int") + (i + 1 == x["came"]).cast("int")))
            return F.struct(
                held.alias("counts"),
                total.alias("total"),
                F.when((total <= most) & (s["low"] < 0), k).otherwise(s["low"]).alias("low"),
                F.when(total <= most, k).otherwise(s["high"]).alias("high"),
            )

        alone = F.struct(when_hot(total).alias("low"), when_hot(total).alias("high"))
        last = F.aggregate(F.sequence(F.lit(1), F.size(codes) - w), start, step, lambda s: F.struct(s["low"].alias("low"), s["high"].alias("high")))
        return F.when(F.size(codes) > w, last).otherwise(alone)

    return bound(begin, slid)


def judge(rule: EntropyRule, earlier: tuple[EntropyRule, ...], allowed: tuple[str, ...]) -> Callable[[Column], Column]:
    """Whether a run is a candidate of ``rule``: it holds what it must, no earlier rule judges it, the allow-list doesn't know it."""

    def candidate(run: Column) -> Column:
        fit = F.lit(True)
        for must in rule.must:
            fit = fit & run.rlike(must)
        for no in (*allowed, *(f"^{x.candidate}$" for x in earlier)):
            fit = fit & ~run.rlike(no)
        return fit

    return candidate


def hot_spans(runs: Column, rule: EntropyRule) -> Column:
    """Of candidates (start, kind, end, run), the stretches whose entropy reaches the threshold."""

    def trimmed(span: Column) -> Column:
        def kept(hot: Column) -> Column:
            found = F.struct((span["start"] + hot["low"]).alias("start"), span["kind"].alias("kind"), (span["start"] + hot["high"] + rule.window).alias("end"))
            return F.when(hot["low"] >= 0, found)

        return bound(hot_window(span["run"], rule), kept)

    return F.filter(F.transform(runs, trimmed), lambda s: s.isNotNull())


def united(spans: Column) -> Column:
    """Spans ordered by start, those that overlap joined into one of the first one's kind."""

    def joined(reach: Column) -> Column:
        new = F.transform(spans, lambda x, k: (k == 0) | (x["start"] >= F.try_element_at(reach, k)))
        heads = F.filter(F.transform(new, lambda n, k: F.when(n, k)), lambda k: k.isNotNull())

        def whole(heads: Column) -> Column:
            last = F.transform(heads, lambda _, k: F.coalesce(F.try_element_at(heads, k + 2), F.size(spans)))
            return F.zip_with(heads, last, lambda a, b: F.struct(F.element_at(spans, a + 1)["start"].alias("start"), F.element_at(spans, a + 1)["kind"].alias("kind"), F.element_at(reach, b).alias("end")))

        return bound(heads, whole)

    ends = running(F.transform(spans, lambda x: x["end"]), F.greatest)
    return F.when(F.size(spans) > 0, bound(ends, joined)).otherwise(F.array().cast(SPAN))


def scan(docs: DataFrame, rules: tuple[EntropyRule, ...] = RULES, allowed: tuple[str, ...] = ALLOWED, carry: bool = False) -> DataFrame:
    """(doc_id, text, base, spans) for each row of ``docs`` (doc_id, text string).

    ``base`` and ``spans`` are arrays of (start, kind, end): code points, end
    exclusive, ``kind`` an index into ``KINDS``, ordered by start, kind and end.
    ``base`` has all leftmost non-overlapping matches of each base pattern that
    are long enough; ``spans`` those and what the entropy rules add; the
    allow-list holds for the latter only.  A null text counts as empty and has no
    spans; rows keep their doc_id (null too), repeated rows give repeated results,
    other columns are ignored (with ``carry`` the whole row also comes out as the
    struct ``row``), and an empty table gives an empty result.
    """
    text = F.col("text")
    base = (
        (ASSIGN, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 12),
        (ACCESS, lambda m: F.length(m) >= 18),
        (HEX, lambda m: F.length(m) >= 16),
    )
    kept = ["row"] if carry else []
    out = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *([F.struct("*").alias("row")] if carry else []))
    low = F.lower(text)
    named = reduce(or_, (F.contains(low, F.lit(w)) for w in WORDS))
    # columns of their own, so that each pattern runs once over a text
    out = out.select("*", F.when(named, matches(text, ASSIGN)).otherwise(F.array().cast("array<string>")).alias("assigned"), matches(text, WIDEST).alias("wide"))
    out = out.select(*kept, "doc_id", "text", located(text, ASSIGN, F.col("assigned"), 0, base[0][1]).alias("m0"), located(text, WIDEST, F.col("wide"), 0).alias("runs"))
    runs = F.col("runs")
    more = [inside(runs, p, k, keep).alias(f"m{k}") for k, (p, keep) in enumerate(base) if k]
    tried = [inside(runs, r.candidate, KINDS.index("entropy"), judge(r, rules[:k], allowed)).alias(f"r{k}") for k, r in enumerate(rules)]
    out = out.select(*kept, "doc_id", "text", "m0", *more, *tried)
    found = F.sort_array(F.concat(*(bare(F.col(f"m{k}")) for k in range(len(base)))))
    hot = F.concat(*(hot_spans(F.col(f"r{k}"), r) for k, r in enumerate(rules)))
    out = out.select(*kept, "doc_id", "text", found.alias("base"), F.sort_array(hot).alias("hot"))
    return out.select(*kept, "doc_id", "text", "base", F.sort_array(F.concat("base", united(F.col("hot")))).alias("spans"))


def told(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(name, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with ``mark`` in place of every maximal stretch that spans cover; spans ordered by start.

    Many stretches are cut from the text's single characters, as finding a place
    in a string takes longer the further it is.
    """

    def pieces(gone: Column, cut: Callable[[Column, Column], Column]) -> Column:
        before = F.transform(gone, lambda x, k: cut(F.when(k > 0, F.try_element_at(gone, k)["end"]).otherwise(0), x["start"]))
        return F.concat(F.array_join(F.transform(before, lambda x: F.concat(x, F.lit(mark))), ""), cut(F.element_at(gone, -1)["end"], F.length(text)))

    def some(gone: Column) -> Column:
        few = pieces(gone, lambda a, b: F.substring(text, a + 1, b - a))
        many = bound(F.split(text, "", -1), lambda one: pieces(gone, lambda a, b: F.array_join(F.slice(one, a + 1, b - a), "")))
        return F.when(F.size(gone) > 64, many).otherwise(few)

    return F.when(F.size(spans) > 0, bound(united(spans), some)).otherwise(text)
