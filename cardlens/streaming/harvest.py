"""Streams: URL harvesting without repeats, sessions and windows in event time, retry gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cardlens.operators.text import extract_url


def read_stream(spark: SparkSession, path: str, schema: StructType, files_each: int = 16) -> DataFrame:
    """A stream of the parquet files below ``path``, ``files_each`` a micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_each).option("recursiveFileLookup", True).parquet(path)


def with_event_time(rows: DataFrame, column: str, delay: str) -> DataFrame:
    """``rows`` with ``column`` as a timestamp and a watermark on it."""
    return rows.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def first_seen(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The first row of each key within the watermark; state is dropped behind it."""
    return rows.dropDuplicatesWithinWatermark(keys)


def harvest_urls(lines: DataFrame, line: str = "line", signed: bool = False) -> DataFrame:
    """Rows whose line holds a complete URL, with ``url``; rows with none or a truncated one
    are left out, and nothing is kept for a later line."""
    url: Column = extract_url(F.col(line))
    done = F.col("url").rlike("(?i)^https?://")
    if signed:
        done = done & F.col("url").rlike("[0-9a-f]{64}$")
    return lines.withColumn("url", url).filter(done)


def sessions(rows: DataFrame, time: str, key: str, gap: str) -> DataFrame:
    """Sessions of a key: start, end and number of events, closed after ``gap`` without any."""
    grouped = rows.groupBy(key, F.session_window(time, gap).alias("w")).agg(F.count("*").alias("n"))
    return grouped.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def windowed_counts(rows: DataFrame, time: str, key: str, width: str) -> DataFrame:
    """Events of a key for each tumbling window."""
    grouped = rows.groupBy(key, F.window(time, width).alias("w")).agg(F.count("*").alias("n"))
    return grouped.select(key, F.col("w.start").alias("start"), "n")


def run_available(stream: DataFrame, path: str, mode: str = "append") -> None:
    """Drain what is there into parquet files at ``path``; a checkpoint makes reruns continue."""
    writer = stream.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", f"{path}/_checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()


def retry_gap(wanted: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What is wanted and not done yet: the work of the next round."""
    return wanted.join(done.select(key).distinct(), key, "left_anti")
