"""Streaming upsert: records arrive as files, the latest of each key is kept as a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from arborlit.operators.latest import last_wins
from arborlit.sources.durable import durable
from arborlit.sources.readers import exists
from arborlit.sources.sinks import remove


def record_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    """New JSON-lines files below a folder, as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _manifests(spark: SparkSession, target: str) -> list[int]:
    """The versions that are complete."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/manifest")
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(where):
        return []
    names = [x.getPath().getName() for x in system.listStatus(where)]
    return sorted(int(x.partition("=")[2]) for x in names if x.startswith("version=") and exists(spark, f"{target}/manifest/{x}/_SUCCESS"))


def manifest(spark: SparkSession, target: str, version: int) -> dict[int, int]:
    """For each bucket of a version of the table the version that wrote it; a version that isn't there is an error."""
    if version not in _manifests(spark, target):
        raise FileNotFoundError(f"{target} has no complete version {version}: the table and the stream's checkpoint don't belong together")
    return {r.bucket: r.written for r in spark.read.schema("bucket int, written int").parquet(f"{target}/manifest/version={version}").collect()}  # a row a bucket


def merge_batch(batch: DataFrame, number: int, target: str, keys: list[str], order: list[str], buckets: int = 64) -> None:
    """Version ``number`` of the table: the one before, with the keys of ``batch`` brought up to date.

    Only the buckets that its keys lie in are read and written.  A batch that runs
    again after a failure overwrites what it wrote itself; a version counts once
    its manifest is there.  Number 0 begins a table.
    """
    spark = batch.sparkSession
    if number == 0 and (later := [v for v in _manifests(spark, target) if v]):
        raise ValueError(f"{target} has versions up to {later[-1]}: a new stream needs a table of its own")
    held = manifest(spark, target, number - 1) if number else {}
    rows = durable(last_wins(batch, keys, order).withColumn("bucket", _bucket(keys, buckets)))
    touched = sorted(r.bucket for r in rows.select("bucket").distinct().collect())  # ``buckets`` at most
    paths = [f"{target}/data/version={held[b]}/bucket={b}" for b in touched if b in held]
    if paths:
        before = spark.read.schema(batch.schema).parquet(*paths).withColumn("bucket", _bucket(keys, buckets))
        rows = last_wins(rows.unionByName(before), [*keys, "bucket"], order)
    if touched:
        rows.repartition(len(touched), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/data/version={number}")
    now = held | dict.fromkeys(touched, number)
    spark.createDataFrame(list(now.items()), "bucket int, written int").coalesce(1).write.mode("overwrite").parquet(f"{target}/manifest/version={number}")


def upsert_latest(stream: DataFrame, target: str, checkpoint: str, keys: list[str], order: list[str], buckets: int = 64) -> StreamingQuery:
    """Keep the table ``target`` at the last row of each key by ``order``; each micro-batch is a version (:func:`merge_batch`)."""

    def merge(batch: DataFrame, number: int) -> None:
        merge_batch(batch, number, target, keys, order, buckets)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_version(spark: SparkSession, target: str, version: int | None = None) -> DataFrame:
    """The newest, or a given, version of an upserted table."""
    complete = _manifests(spark, target)
    held = manifest(spark, target, complete[-1] if version is None and complete else version or 0)
    paths = [f"{target}/data/version={v}/bucket={b}" for b, v in sorted(held.items())]
    return spark.read.parquet(*paths)


def tidy(spark: SparkSession, target: str, keep: int = 2) -> int:
    """Delete the buckets and manifests that none of the newest ``keep`` versions needs; returns how many buckets went."""
    complete = _manifests(spark, target)
    kept = complete[-keep:]
    needed = {(b, v) for k in kept for b, v in manifest(spark, target, k).items()}
    old = {(b, v) for k in complete for b, v in manifest(spark, target, k).items()} - needed
    for b, v in old:
        remove(spark, f"{target}/data/version={v}/bucket={b}")
    for v in set(complete) - set(kept):
        remove(spark, f"{target}/manifest/version={v}")
    return len(old)


def counts_by_window(stream: DataFrame, time: str, key: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(start, key, n) by tumbling windows; rows later than the watermark are left out."""
    windows = stream.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), key).agg(F.count("*").alias("n"))
    return windows.select(F.col("w.start").alias("start"), key, "n")
