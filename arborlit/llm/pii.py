"""Personal data by fixed forms and by bootstrapped contexts.

Four forms (``email ip card phone``) are found as they are; every hit is a seed.
Seeds and other tokens that hold digits or an at sign are the instances, the
words around them the patterns, and both form a graph.  A pattern is trusted for
a kind by the share of its distinct instances that are of that kind, an unknown
instance by the patterns that it stands in, in turns (in the manner of DIPRE and
Snowball: Brin, 1998; Agichtein and Gravano, 2000).  Places where a trusted
pattern holds an unknown instance of a fitting shape are added.

Texts are scanned in tasks; the graph is joined and summed by Spark.  Scores are
whole numbers, so reruns agree.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from arborlit.llm.session import bounded_batches, durable

KINDS = ("email", "ip", "card", "phone")
ONE = 1_000_000  # the score of a seed

# Every expression below is linear in the text: possessive, and begun only where a match can begin.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]++")
_ANY = re.compile(r"[0-9@]|[(\[]at[)\]]")
_TOKEN = re.compile(r"(?<![^\x20\x09-\x0D])(?:[^\x20\x09-\x0D0-9@(\[]|[(\[](?!at[)\]]))*+(?:[0-9@]|[(\[]at[)\]])[^\x20\x09-\x0D]*+")
_NUMBER = re.compile(r"[+(]?[0-9][0-9().+/-]*+")
_LINE = re.compile(r"[\x0A-\x0D]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_PUNCTUATION = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
_LEFT_EDGE, _RIGHT_EDGE = _PUNCTUATION.replace("(", "").replace("+", ""), _PUNCTUATION.replace(")", "")

_FITS = (
    re.compile(r"[^@\s]+(?:@|[(\[]at[)\]])[^@\s]+"),
    re.compile(r"[0-9A-Fa-f]{1,4}(?:[.:]{1,2}[0-9A-Fa-f]{1,4}){2,7}"),
    re.compile(r"(?:[0-9][ .-]?){12,24}"),
    re.compile(r"\(?(?:[0-9][ ()./-]{0,2}){6,14}[0-9]"),
)


@dataclass(frozen=True)
class Bootstrap:
    """``rounds`` of scoring; a pattern is trusted from ``trust`` (in millionths) and ``support`` distinct instances of the kind on; contexts are read from ``reach`` characters a side."""

    rounds: int = 3
    trust: int = 600_000
    support: int = 3
    reach: int = 100


def luhn(digits: str) -> bool:
    """Whether the check digit is right."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            done = m.end()


def addresses(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(x) <= 3 and int(x or 0) <= 255 for x in (p.lstrip("0") for p in m[0].split("."))):
            yield m.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if 13 <= m.end() - m.start() < 40 and 13 <= len(digits := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        held = m[0].rstrip(" ().-")
        if len(held) > 3 and 9 <= len(_NOT_DIGIT.sub("", held)) <= 15:
            yield m.start(), m.start() + len(held)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all hits of the four forms, by kind, then start; leftmost and non-overlapping within a kind, failing ones dropped."""
    out = []
    if "@" in text:
        out += [(0, *x) for x in emails(text)]
    if _DIGIT.search(text):
        out += [(1, *x) for x in addresses(text)] if "." in text else []
        out += [(2, *x) for x in cards(text)]
        out += [(3, *x) for x in phones(text)] if "+" in text else []
    return out


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Tokens that hold a digit or an at sign, numbers with single spaces between as one; none that touches a span of ``taken``."""
    tokens: list[list[int]] = []
    number = False
    for m in _TOKEN.finditer(text):
        joined = number and m.start() == tokens[-1][1] + 1 and text[m.start() - 1] == " "
        number = _NUMBER.fullmatch(text, m.start(), m.end()) is not None
        if joined and number:
            tokens[-1][1] = m.end()
        else:
            tokens.append([*m.span()])
    out, spans, k = [], sorted((s, e) for _, s, e in taken), 0
    last = 0  # the furthest end of the spans before place k
    for start, end in tokens:
        while k < len(spans) and spans[k][0] < end:
            last = max(last, spans[k][1])
            k += 1
        if last > start:
            continue
        held = text[start:end]
        low, high = end - len(held.lstrip(_LEFT_EDGE)), start + len(held.rstrip(_RIGHT_EDGE))
        if low < high:
            out.append((low, high))
    return out


def short(text: str) -> str:
    """A text of more than 64 characters as its digest, so that keys are bounded."""
    return text if len(text) <= 64 else sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def patterns(text: str, start: int, end: int, reach: int) -> list[str]:
    """The lexical patterns around a span, digits as 0: two words before, one before and one after, one before.

    ``+`` marks a word that the span is part of, ``^`` and ``$`` that the line, or
    the reach, has no more.
    """
    before = _LINE.split(_DIGIT.sub("0", text[max(0, start - reach) : start].lower()))[-1]
    after = _LINE.split(_DIGIT.sub("0", text[end : end + reach].lower()))[0]
    left = ["^", "^", *before.split()][-2:]
    if before and not before[-1].isspace():
        left[-1] += "+"
    right = next(iter(after.split()), "$")
    return [f"2 {left[0]} {left[1]} _", f"1 {left[1]} _ {right}", f"1 {left[1]} _"]


def fits(instance: str) -> int:
    """A bit for each kind whose shape a text has."""
    return sum(1 << k for k, shape in enumerate(_FITS) if shape.fullmatch(instance))


FOUND = pa.schema(
    [
        ("row", pa.int64()),
        ("doc_id", pa.int64()),
        ("base", pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))),
        ("places", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("seed", pa.int32()), ("fits", pa.int32()), ("instance", pa.string()), ("patterns", pa.list_(pa.string()))]))),
    ]
)
CHUNK = 5000  # places in a row of the scan


def scan(docs: DataFrame, how: Bootstrap = Bootstrap()) -> DataFrame:
    """(row, doc_id, base, places): for each row of ``docs`` its base spans, and its seeds and candidates with their patterns.

    ``row`` numbers the rows; one with very many places has more than one row
    here, all but the first without ``base``.
    """
    bounded_batches(docs.sparkSession)

    def places(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple]:
        known = [(start, end, kind, 0) for kind, start, end in base]
        for start, end, seed, shapes in [*known, *((*x, -1, fits(text[slice(*x)])) for x in candidates(text, base))]:
            yield start, end, seed, shapes, short(text[start:end].lower()), list(map(short, patterns(text, start, end, how.reach)))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), FOUND, strict=True)], schema=FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows, held = [], 0
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                row += 1
                if not text or not _ANY.search(text):
                    rows.append((row, doc_id, [], []))
                    continue
                base = base_spans(text)
                each = places(text, base)
                rows.append((row, doc_id, base, list(islice(each, CHUNK))))
                held += len(rows[-1][3])
                while held >= CHUNK:
                    yield batch_of(rows)
                    rows, held = [], 0
                    if more := list(islice(each, CHUNK)):
                        rows, held = [(row, doc_id, None, more)], len(more)
            if rows:
                yield batch_of(rows)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return durable(texts.mapInArrow(run, from_arrow_schema(FOUND)))


def graph(places: DataFrame) -> DataFrame:
    """(pattern, instance, seed, fits): each distinct pair of a pattern and an instance that stands in it; seed is the kind of a seed, else -1.

    Repeats of a text add nothing to it.
    """
    edges = places.select(F.explode("patterns").alias("pattern"), "instance", "seed", "fits")
    return edges.groupBy("pattern", "instance").agg(F.max("seed").alias("seed"), F.max("fits").alias("fits"))


def _trust(k: int) -> Column:
    return F.coalesce(F.col(f"trust{k}"), F.lit(0))


def pattern_scores(edges: DataFrame, instances: DataFrame | None, how: Bootstrap) -> DataFrame:
    """(pattern, trust0 ...): the sum of a kind's scores over the distinct instances plus one, where that and the number of such instances suffice; else 0.

    ``instances`` has the scores of unknown instances so far (instance, score0 ...).
    """
    held = edges if instances is None else edges.join(instances, "instance", "left")
    score = [F.when(F.col("seed") == k, ONE).otherwise(F.lit(0) if instances is None else F.when(F.col("seed") < 0, F.coalesce(F.col(f"score{k}"), F.lit(0))).otherwise(0)) for k in range(len(KINDS))]
    sums = [x for k, s in enumerate(score) for x in (F.sum(s).alias(f"sum{k}"), F.count_if(s >= how.trust).alias(f"good{k}"))]
    told = held.groupBy("pattern").agg(F.count("*").alias("n"), *sums)
    trust = [F.expr(f"sum{k} DIV (n + 1)") for k in range(len(KINDS))]
    enough = [(F.col(f"good{k}") >= how.support) & (trust[k] >= how.trust) for k in range(len(KINDS))]
    kept = told.select("pattern", *[F.when(enough[k], trust[k]).otherwise(0).alias(f"trust{k}") for k in range(len(KINDS))])
    return kept.where(" OR ".join(f"trust{k} > 0" for k in range(len(KINDS))))


def instance_scores(edges: DataFrame, trusted: DataFrame) -> DataFrame:
    """(instance, score0 ...) of unknown instances: the most trusted pattern of a kind whose shape the instance has."""
    held = edges.where("seed < 0 AND fits > 0").join(trusted, "pattern")
    return held.groupBy("instance").agg(*[F.max(F.when(F.col("fits").bitwiseAND(F.lit(1 << k)) > 0, F.col(f"trust{k}")).otherwise(0)).alias(f"score{k}") for k in range(len(KINDS))])


def trusted_patterns(places: DataFrame, how: Bootstrap = Bootstrap()) -> DataFrame:
    """(pattern, trust0 ...) after ``how.rounds`` rounds of scoring patterns by instances and instances by patterns."""
    edges = graph(places)
    spread = edges.groupBy("pattern").agg(F.count("*").alias("n")).where(F.col("n") >= how.support).select("pattern")
    edges = durable(edges.join(spread, "pattern"))  # a pattern of fewer instances is never trusted
    trusted = durable(pattern_scores(edges, None, how))
    for _ in range(how.rounds - 1):
        trusted = durable(pattern_scores(edges, instance_scores(edges, trusted), how))
    return trusted


def find(docs: DataFrame, how: Bootstrap = Bootstrap()) -> DataFrame:
    """(doc_id, base, spans) for each row of ``docs`` (doc_id, text): arrays of (kind, start, end), in code points, end exclusive.

    ``base`` has the hits of the four forms (kind 0 to 3, the place in ``KINDS``),
    ordered by kind and start; ``spans`` has these and what trusted patterns add,
    each of the kind that its most trusted pattern speaks for, none overlapping a
    base span.  Null texts count as empty; null and repeated ids and repeated rows
    are rows of their own, though repeats of a text don't strengthen a pattern;
    other columns are ignored; an empty table gives an empty result.
    """
    found = scan(docs, how)
    places = found.select("row", F.explode("places").alias("p")).select("row", "p.*")
    trusted = trusted_patterns(places, how)
    open_places = places.where("seed < 0 AND fits > 0").select("row", "start", "end", "fits", F.explode("patterns").alias("pattern"))
    best = open_places.join(trusted, "pattern").select("row", "start", "end", F.greatest(*[F.struct(F.when(F.col("fits").bitwiseAND(F.lit(1 << k)) > 0, _trust(k)).otherwise(0).alias("trust"), F.lit(-k).alias("kind")) for k in range(len(KINDS))]).alias("best"))
    best = best.where("best.trust > 0").groupBy("row", "start", "end").agg(F.max("best").alias("best"))
    added = best.groupBy("row").agg(F.collect_list(F.struct((-F.col("best.kind")).cast("int").alias("kind"), "start", "end")).alias("added"))
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    return found.where("base IS NOT NULL").join(added, "row", "left").select("doc_id", "base", F.array_sort(F.concat("base", F.coalesce("added", none))).alias("spans"))


def told(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")
