"""What the operators of this subpackage share: reliable checkpoints and row identifiers."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words as the contracts define them: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def checkpoint_dir(spark: SparkSession) -> None:
    """Make sure that reliable checkpoints have a folder.

    The cluster's own ``spark.checkpoint.dir`` wins. Only a local master, where driver and
    executors share a disk, gets a folder of our own.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "/tmp/checkpoints"
    sc.setCheckpointDir(folder)


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and cut its lineage there."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def saved(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table beside the checkpoints and read it again.

    For tables that a loop derives from each other: a checkpoint hands on the estimated size of
    its plan, which grows with every join; a written table has the size of its files.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` with its rows numbered in a column of a fresh name, written as a checkpoint: whoever
    reads it, and however its scan is planned, a row keeps its number."""
    name = fresh(df, "_row_uid")
    return checkpoint(df.withColumn(name, F.monotonically_increasing_id())), name


def unit_hash(*cols: Column | str) -> Column:
    """A number in [0, 1) that depends only on the values of ``cols``."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))
