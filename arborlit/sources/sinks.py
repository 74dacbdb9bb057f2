"""Writers: document tables, caches, facts, bundles, failed ids, split bundles, manifests.

Every writer replaces or appends whole files; Spark commits them when a job has
ended, so a run that fails leaves nothing half written.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborlit.functions import text as X
from arborlit.sources import schemas as S


def _csv(df: DataFrame, path: str, mode: str) -> None:
    df.write.mode(mode).option("header", True).option("escape", '"').option("quote", '"').option("emptyValue", "").csv(path)


def write_documents(documents: DataFrame, path: str, names: dict[str, str] | None = None) -> None:
    """The document table with its fixed columns; ``names`` renames some for other readers."""
    _csv(documents.select(*(F.col(c).alias((names or {}).get(c, c)) for c in S.DOCUMENT_COLUMNS)), path, "overwrite")


def append_cache(records: DataFrame, path: str) -> None:
    """Records as gzip JSON lines, in new files beside the old ones."""
    records.write.mode("append").option("compression", "gzip").json(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it's there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def write_facts(facts: DataFrame, path: str, append: bool = False) -> None:
    _csv(facts.select(*S.FACT_COLUMNS), path, "append" if append else "overwrite")


def write_failed(documents: DataFrame, path: str, stamp: str | None = None) -> int:
    """The ids that failed, one a line, and a copy with a time in its name; without any, the list is removed."""
    failed = documents.where("fetch_status = 'failed'").select("pmid").distinct()
    spark, n = documents.sparkSession, failed.count()
    if n:
        stamp = stamp or datetime.now(UTC).strftime("%Y%m%d_%H%M%S")
        copy = path.replace(".txt", f"_{stamp}.txt") if path.endswith(".txt") else f"{path}_{stamp}"
        for target in (path, copy):
            failed.orderBy("pmid").write.mode("overwrite").text(target)
    else:
        remove(spark, path)
    return n


def download(rows: DataFrame, path: str) -> str:
    """A result as one CSV file with a header, for a user to take away; what is one file is written by one task."""
    _csv(rows.coalesce(1), path, "overwrite")
    return path


PARALLEL = (("factors", "factor", "factor"), ("citations", "number_citations", "number_citations"), ("hard_category", "hard_category", "hard_category"), ("formats", "format", "format"))


def bundle_row(tree: DataFrame, documents: DataFrame, order: tuple[str, ...] = ("pmid",), merged: bool = False) -> DataFrame:
    """One row (json): the tree, the documents and the parallel arrays in the documents' order.

    A bundle is one JSON value by its format, so this gathers it; it is an export
    for browsers, and everything else works on tables.
    """
    entries = tree.select("*").withColumn("__o", F.struct(-X.count_value("count(*)"), F.col("first"), F.col("tree_id"))).groupBy().agg(F.sort_array(F.collect_list(F.struct("__o", F.struct(*tree.columns).alias("v")))).alias("t"))
    columns = [c for c in documents.columns if c not in ("ord",)]
    docs = documents.groupBy().agg(F.sort_array(F.collect_list(F.struct(F.struct(*order).alias("o"), F.struct(*columns).alias("v")))).alias("d"))
    both = entries.crossJoin(docs)  # one row each
    lists = [_list(*x) for x in (*PARALLEL, *((("categories", "cat", "cat"),) if merged else ())) if x[1] in columns]
    return both.select(F.to_json(F.struct(F.col("t.v").alias("tree"), F.col("d.v").alias("docs"), *lists)).alias("json"))


def _list(name: str, column: str, key: str):
    return F.transform("d.v", lambda v: F.struct(v[column].alias(key))).alias(name)


def write_bundle(tree: DataFrame, documents: DataFrame, path: str, **options) -> None:
    bundle_row(tree, documents, **options).write.mode("overwrite").text(path)


def write_bundle_parts(tree: DataFrame, documents: DataFrame, path: str, order: tuple[str, ...] = ("pmid",), merged: bool = False, files: int | None = None) -> None:
    """The arrays of :func:`write_bundle` as a folder of JSON files, each an object with some records of some arrays, in order from file to file.

    Any number of tasks write it, none holds more than a batch, and
    ``readers.bundle`` reads it as it reads the one file.  ``order``'s columns are
    compared as text.  A file holds a range of documents, so what the parallel arrays
    say of them too.  An array without records is in no file.
    """
    spark = tree.sparkSession
    record = lambda v: F.to_json(v, {"ignoreNullFields": "false"})
    columns = [c for c in documents.columns if c != "ord"]
    given = [x for x in (*PARALLEL, *((("categories", "cat", "cat"),) if merged else ())) if x[1] in columns]
    names = ["tree", "docs", *(x[0] for x in given)]
    keys = [f"key{k}" for k in range(max(2, len(order)))]
    keyed = lambda values: [(values[k] if k < len(values) else F.lit("")).alias(c) for k, c in enumerate(keys)]
    none = lambda df, cols: F.lit(None).cast(df.select(F.struct(*cols)).schema[0].dataType)
    rows = tree.select(F.lit(0).alias("no"), (-X.count_value("count(*)")).cast("long").alias("n"), *keyed([F.col("first"), F.col("tree_id")]), F.struct(*tree.columns).alias("t"), none(documents, columns).alias("d"))
    rows = rows.unionByName(documents.select(F.lit(1).alias("no"), F.lit(0).cast("long").alias("n"), *keyed([F.col(c).cast("string") for c in order]), none(tree, tree.columns).alias("t"), F.struct(*columns).alias("d")))
    of_document = F.array(record(F.col("d")), *(record(F.struct(F.col("d")[column].alias(key))) for _, column, key in given))

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if batch.num_rows and last is not None and pc.all(pc.equal(batch.column(0), last)).as_py():  # the array goes on
                yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(", ", batch.column(1), "")], names=["value"])
                continue
            out = []
            for no, record in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                begin = "{" if last is None else "], "
                out.append(f", {record}" if no == last else f"{begin}{json.dumps(names[no])}: [{record}")
                last = no
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array(["]}"])], names=["value"])

    # documents are worked out and dealt once; the arrays part within their ranges
    dealt = rows.repartitionByRange(files or int(spark.conf.get("spark.sql.shuffle.partitions")), "no", "n", *keys)
    parted = dealt.select("no", "n", *keys, F.posexplode(F.when(F.col("no") == 0, F.array(record(F.col("t")))).otherwise(of_document)).alias("at", "json")).withColumn("no", F.col("no") + F.col("at")).sortWithinPartitions("no", "n", *keys)
    parted.select("no", "json").mapInArrow(lines, "value string").write.mode("overwrite").text(path)


def write_split(tree: DataFrame, documents: DataFrame, path: str) -> None:
    """Tree entries and documents, each partitioned by the slug of their bucket."""
    for name, df in (("tree", tree), ("docs", documents)):
        df.withColumn("slug", X.slug("bucket")).write.mode("overwrite").partitionBy("slug").parquet(f"{path}/{name}")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(file, size_bytes, synced_at) of the files below a folder, sizes as text."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    return files.select(X.id_tail("path").alias("file"), F.col("length").cast("string").alias("size_bytes"), F.lit(datetime.now(UTC).isoformat()).alias("synced_at")).orderBy("file")


def sync(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Copy a folder's files over another's, deleting nothing, and return the target's manifest."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    a, b = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    here, there = a.getFileSystem(conf), b.getFileSystem(conf)
    there.mkdirs(b)
    for status in here.listStatus(a):
        jvm.org.apache.hadoop.fs.FileUtil.copy(here, status.getPath(), there, jvm.org.apache.hadoop.fs.Path(b, status.getPath().getName()), False, True, conf)
    return manifest(spark, target)
