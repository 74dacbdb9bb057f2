"""Cutting lineage in the shared checkpoint folder."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.

    On a cluster it must be set; in local mode the warehouse is used where it isn't.
    """
    sc = spark.sparkContext
    held = sc._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    path = sc.getConf().get("spark.checkpoint.dir")
    if not path and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    sc.setCheckpointDir(path or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints")
    return sc._jsc.sc().getCheckpointDir().get()


def durable(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read from there."""
    folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """As :func:`durable`, in columns: for rows of which later steps read a few columns only."""
    path = f"{folder(df.sparkSession)}/stored-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
