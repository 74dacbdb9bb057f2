"""Target-distribution importance resampling over hashed n-gram features.

A document's features are its runs of one to three words, each hashed to a
bucket.  A bucket's gain is the logarithm of how much likelier it is in the
target texts than in the corpus; a document's weight is the sum over its
features, and the highest weights after Gumbel noise are drawn (Xie et al.,
2023).  Everything stays in built-in expressions: words by split, n-grams by
zipping shifted arrays, buckets by crc32.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborlit.llm.ranking import positions
from arborlit.llm.session import durable

BUCKETS = 10_000
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, nothing else changed; ASCII texts by the faster ``lower``."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words(text: Column) -> Column:
    """The words of a text in lower case; null has none."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def features(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """A row for each run of 1 to 3 words of the array ``words``: the other columns, and ``bucket``.

    At the end of a text the longer runs are null, and a text without words has
    null runs only, so every row of ``rows`` is there.
    """
    kept = [c for c in rows.columns if c != "words"]
    each = rows.select(*kept, F.inline_outer(F.arrays_zip(F.col("words").alias("a"), F.slice("words", 2, F.size("words")).alias("b"), F.slice("words", 3, F.size("words")).alias("c"))).alias("a", "b", "c"))
    pair = F.concat("a", F.lit(" "), "b")
    each = each.select(*kept, F.explode(F.array("a", pair, F.concat(pair, F.lit(" "), "c"))).alias("gram"))
    return each.select(*kept, (F.crc32(F.col("gram").cast("binary")) % buckets).alias("bucket"))


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many features of all ``text`` lie in each bucket that has any."""
    return features(texts.select(words(F.col("text")).alias("words")), buckets).where("bucket IS NOT NULL").groupBy("bucket").agg(F.count("*").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) for every bucket: floor(1000 ln(p / q)), p and q the bucket's smoothed shares of target and corpus; ``buckets`` rows, whatever the data."""
    spark = docs.sparkSession
    s, t = durable(bucket_counts(docs, buckets).withColumnRenamed("n", "s")), durable(bucket_counts(target, buckets).withColumnRenamed("n", "t"))
    all_s, all_t = (x.agg(F.coalesce(F.sum(c), F.lit(0))).first()[0] for x, c in ((s, "s"), (t, "t")))
    held = spark.range(buckets).withColumnRenamed("id", "bucket").join(s, "bucket", "left").join(t, "bucket", "left")
    share = lambda c, n: (F.coalesce(c, F.lit(0)) + 1).cast("double") * F.lit(float(n + buckets))
    return held.select("bucket", F.floor(1000 * F.log(share("t", all_s) / share("s", all_t))).alias("gain"))


def noise(doc_id: Column, seed: int = 42) -> Column:
    """floor(-1000 ln(-ln u)), u from the SHA-256 of seed and id; a null id counts as empty."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8)
    u = (F.conv(digits, 16, 10).cast("long").cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(-1000 * F.log(-F.log(u)))


def weights(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, tie, n_words, n_features, weight) for each row of ``docs``; ``tie`` is a hash of the text.

    All features of a row are in one task, so sums are complete before they are
    shuffled and the shuffle carries a row a document.
    """
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), words(F.col("text")).alias("words"))
    rows = found.select(F.monotonically_increasing_id().alias("row"), "doc_id", "tie", F.size("words").alias("n_words"), "words")
    joined = features(rows, buckets).join(F.broadcast(gains(docs, target, buckets)), "bucket", "left")  # ``buckets`` rows
    summed = joined.groupBy("row", "doc_id", "tie", "n_words").agg(F.count("bucket").alias("n_features"), F.coalesce(F.sum("gain"), F.lit(0)).alias("weight"))
    return summed.drop("row")


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) for each row of ``docs`` (doc_id, text).

    Of the N rows with at least ``least_words`` words, the floor(percent * N / 100)
    highest scores are drawn and ranked from 1; rank is null for all others.  Ties
    go to the smaller doc_id, nulls last, then by a hash of the text.  A null text
    has no features and weight 0; a null id takes part; repeated rows are rows of
    their own; other columns are ignored; an empty table gives an empty result,
    and an empty ``target`` (text) leaves smoothed shares only.
    """
    scored = weights(docs, target, buckets).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)).withColumn("able", F.col("n_words") >= least_words)
    placed = positions(scored, [F.col("able").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("tie")])
    able = placed.agg(F.count_if("able")).first()[0]
    drawn = F.col("able") & (F.col("position") <= F.lit(percent * able // 100))
    return placed.select("doc_id", "n_features", "weight", "score", F.when(drawn, F.col("position")).alias("rank"))
