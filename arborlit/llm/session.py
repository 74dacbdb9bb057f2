"""Session helpers: durable intermediate results and partition counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``; on a cluster it must be set, in local mode the warehouse is used where it isn't."""
    sc = spark.sparkContext
    held = sc._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    path = sc.getConf().get("spark.checkpoint.dir")
    if not path:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints"
    sc.setCheckpointDir(path)
    return path


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and cut its lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def free_finished(spark: SparkSession) -> None:
    """Have the session drop the shuffle files of each action when it ends; by default they stay as long as the driver knows the plan."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def parts(spark: SparkSession, times: int = 4) -> int:
    """How many groups a packed exchange uses: a multiple of the session's shuffle partitions."""
    return max(8, times * int(spark.conf.get("spark.sql.shuffle.partitions")))


def bounded_batches(spark: SparkSession, rows: int = 2000, size: int = 8 << 20) -> None:
    """Hold the session's Arrow batches to ``rows`` and ``size`` bytes, so that long texts don't make large ones."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        now = int(spark.conf.get(key).rstrip("b"))
        if not 0 < now <= most:
            spark.conf.set(key, str(most))
