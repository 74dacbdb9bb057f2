"""Mixing sources to target weights by hash-threshold histograms.

Every document has a fixed 60-bit hash.  A source's budget is met by taking whole
copies of the source as often as they fit, and of one more copy the documents
whose hash is below a threshold.  The threshold is found digit by digit: sizes
are summed by source and leading hash bits, the bucket that the budget ends in
is refined by the next bits, and so on, so that after the last digit the
documents taken are all those, in hash order, that fit the budget, and the next
one if that lands nearer.  Nothing is
sorted, and thresholds are nested: a larger budget takes a superset.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arborlit.llm.session import durable

HASH_BITS = 60
DIGIT_BITS = 12
BROADCAST_SOURCES = 1000
WORD = r"[^\x20\x09-\x0D]+"


def hash60(doc_id: Column) -> Column:
    """The first 15 hexadecimal digits of the MD5 of the id's decimal form (of the word null, if it is null)."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("null"))), 1, 15)
    return F.conv(digits, 16, 10).cast("long")


def targets(totals: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """(source, source_size, target): ``share`` of all sizes by weight, none above ``cap`` times its source.

    What a capped source leaves is shared by weight among the others until none
    is above; that ends where all others stand at one level a weight, found here
    by ordering sources by cap over weight.
    """
    everything = W.partitionBy()
    named = totals.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights))) + 1))
    named = named.withColumn("most", F.col("source_size") * F.lit(float(cap))).withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
    order = W.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    named = named.withColumn("rank", F.row_number().over(order))
    level = (F.col("budget") - F.coalesce(F.sum("most").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))) / F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    named = named.withColumn("level", level)
    fits = F.when(F.col("level") * F.col("weight") <= F.col("most"), F.struct("rank", "level"))
    named = named.withColumn("level", F.min(fits).over(everything)["level"])
    target = F.when(F.col("level").isNull(), F.col("most")).otherwise(F.least("most", F.col("level") * F.col("weight")))
    return named.select("source", "source_size", target.alias("target"))


@dataclass(frozen=True)
class Plan:
    """What is taken of each source: (source, source_size, target, whole, limit), and whether the sources are few."""

    sources: DataFrame
    small: bool

    def copies(self, docs: DataFrame) -> DataFrame:
        """(row, source_size, target, copies): each row of ``docs`` (doc_id, source, ...) whole, as a struct, and how often the mix takes it.

        Whatever other columns the rows have, their names can't clash.  Rows of a
        source that the plan doesn't have are left out; null and repeated ids and
        repeated rows are rows of their own; an empty table gives an empty result.
        """
        held = docs.select(F.struct("*").alias("row"), F.col("source").cast("string").alias("source"), hash60(F.col("doc_id")).alias("h"))
        extra = F.when(F.col("h") < F.col("limit"), 1).otherwise(0)
        copies = F.when(F.col("source_size") > 0, F.col("whole") + extra).otherwise(0)
        return _with_sources(held, self.sources, self.small).select("row", "source_size", "target", copies.alias("copies"))


def _with_sources(left: DataFrame, right: DataFrame, small: bool) -> DataFrame:
    """Inner join by source, nulls equal; broadcast if the sources are few."""
    right = right.withColumnRenamed("source", "__source")
    return left.join(F.broadcast(right) if small else right, left["source"].eqNullSafe(right["__source"])).drop("__source")


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): the number of words of each text."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), size.alias("size"))


def plan(sizes: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, cap: float = 2.0) -> Plan:
    """What to take of each source of ``sizes`` (doc_id, source, size).

    A null source is one of its own; null ids share a hash, as repeated ones do, and
    are taken together; repeated rows count as often as they are there; other columns
    are ignored; an empty table gives an empty plan.
    """
    hashed = sizes.select("source", "size", hash60(F.col("doc_id")).alias("h"))
    budget = durable(targets(hashed.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap))
    small = budget.count() <= BROADCAST_SOURCES
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    budget = budget.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    bound = budget.select("source", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("before"), "rest")
    for shift in range(HASH_BITS - DIGIT_BITS, -1, -DIGIT_BITS):
        inside = _with_sources(hashed, bound, small).where(F.shiftright("h", shift + DIGIT_BITS) == F.col("prefix"))
        sums = inside.groupBy("source", F.shiftright("h", shift).alias("bucket")).agg(F.sum("size").alias("n"), F.first("before").alias("before"), F.first("rest").alias("rest"))
        order = W.partitionBy("source").orderBy("bucket")
        sums = sums.withColumn("upto", F.col("before") + F.sum("n").over(order))
        over = sums.where("upto > rest").groupBy("source").agg(F.min(F.struct("bucket", (F.col("upto") - F.col("n")).alias("before"), "rest", "upto")).alias("b"))
        bound = over.select("source", F.col("b.bucket").alias("prefix"), "b.before", "b.rest", "b.upto")
    nearer = F.col("upto") - F.col("rest") < F.col("rest") - F.col("before")
    limits = bound.select(F.col("source").alias("s"), (F.col("prefix") + nearer.cast("long")).alias("limit"))
    sources = budget.join(limits, budget["source"].eqNullSafe(F.col("s")), "left").select("source", "source_size", "target", "whole", "limit")
    return Plan(durable(sources), small)


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) for each row of ``docs`` (doc_id, text, source string).

    ``size`` is the number of words of a text (null: 0), runs of characters other
    than ``\\x20 \\x09-\\x0D``.  Sources in code-point order, null last as a source
    of its own, have ``weights`` in turn.  ``target`` is double, see
    :func:`targets`.  ``copies`` says how often the mix takes a document: at least
    floor(target / source_size) times, and once more if all documents of its
    source with a hash up to its own fit what is left of the target, or, for the
    first hash that doesn't fit, if the source's words come nearer to the target
    with it than without.  So they miss it by half the size of the documents with
    that hash at most, and no document is taken more than twice.  Equal doc_ids
    share a hash and are taken together; a source without words has copies 0.  Other columns are ignored; an empty
    table gives an empty result; reruns agree, whatever the partitioning.
    """
    sizes = durable(sized(docs))
    return plan(sizes, weights, share, cap).copies(sizes).select("row.*", "source_size", "target", "copies")


MIX_SQL = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS h
    FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
    SELECT source, source_size, source_size * 2.0::DOUBLE AS most,
           list_extract([3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE], ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT) AS weight,
           sum(source_size) OVER () * 1.5::DOUBLE AS budget
    FROM totals),
ranked AS (SELECT *, row_number() OVER (ORDER BY most / weight, source NULLS LAST) AS rank FROM weighed),
levels AS (
    SELECT *, (budget - coalesce(sum(most) OVER (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(weight) OVER (ORDER BY rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM ranked),
chosen AS (SELECT *, (SELECT arg_min(level, rank) FROM levels WHERE level * weight <= most) AS common FROM levels),
aims AS (SELECT source, source_size, CASE WHEN common IS NULL THEN most ELSE least(most, common * weight) END AS target FROM chosen),
parts AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM aims),
summed AS (
    SELECT *, sum(size) OVER (PARTITION BY source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
           coalesce(sum(size) OVER (PARTITION BY source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP), 0) AS below
    FROM sized),
left_over AS (SELECT s.*, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS rest FROM summed s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN upto <= rest OR (below <= rest AND upto - rest < rest - below) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM left_over
"""
