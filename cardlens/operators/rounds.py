"""Tables that loops derive from each other, written to the shared folder of the cluster."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder for checkpoints: ``spark.checkpoint.dir``; only where it is unset and the master is local, one of our own."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or "/tmp/checkpoints")
    return sc.getCheckpointDir()


def saved(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in ``checkpoint_folder`` and read it again.

    Lineage ends there, and the plan that follows knows the size of the files.
    """
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
