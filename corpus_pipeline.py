"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from uuid import uuid4

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborlit.llm import bpe, mixing, ngram_join, secret_scan, toxicity
from arborlit.llm.session import checkpoint_dir, durable

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier trained on the labelled ones doesn't reject.

    Null texts count as empty; null and repeated ids and repeated rows are judged like
    others; without labels nothing is rejected; an empty table stays empty.
    """
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.accepted(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, that of the smallest doc_id, null last; repeated and null doc_ids are rows like others.

    Rows are numbered in a stored copy, so that every pass sees the same numbers.
    """
    path = f"{checkpoint_dir(spark)}/numbered-{uuid4().hex}"
    docs.withColumn("__row", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    found = durable(ngram_join.jaccard_components(rows.select(F.col("__row").alias("doc_id"), "text")).select(F.col("doc_id").alias("__row"), "component_id"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row"))
    kept = found.join(rows.select("__row", "doc_id"), "__row").groupBy("component_id").agg(first.alias("first")).select("first.__row")
    gone = found.select("__row").join(kept, "__row", "left_anti")
    return rows.join(gone, "__row", "left_anti").select(docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by a mark, n_chars counted anew; null texts become empty."""
    found = secret_scan.scan(docs, carry=True)
    text = secret_scan.redacted(F.col("text"), F.col("spans"))
    kept = found.select("row", text.alias("text"))
    columns = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return kept.select(*(columns.get(c, F.col("row")[c]).alias(c) for c in docs.columns))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    Null texts have no words and are taken with their source's whole copies; a null
    source is one of its own; rows that share an id, or have none, are taken together;
    columns come out as they are, whatever their names; an empty table stays empty.
    """
    taken = mixing.plan(durable(mixing.sized(docs))).copies(docs)
    return taken.where("copies > 0").select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("row.*")


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256): every text's tokens, and the digest of what they decode to.

    Null texts count as empty and have no tokens; null and repeated ids and repeated
    rows come out as rows of their own; an empty table gives an empty result.
    """
    ranks = bpe.read_ranks(VOCABULARY)
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded=True)
    return encoded.select("doc_id", "n_tokens", "ids", F.sha2("data", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("secret_scans", redact_secrets),
    ("mix_sources", mix),
    ("byte_bpe", tokenise),
]

#: Training and token merges are beyond SQL; tests/llm/test_tables.py holds every stage against plain loops.
ORACLE_SQL = None


def _drop(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written to the shared folder and read again.

    A stage's folder goes when the next one is written; the last one stays, as
    the result is read from it.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder, before = f"{checkpoint_dir(spark)}/pipeline-{uuid4().hex}", None
    for name, stage in STAGES[:-1]:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            _drop(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
