"""Ordered operators: islands, stability, circular spans, running windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def islands(rows: DataFrame, value: str, gap: float) -> DataFrame:
    """doc_id, block, first, last, n: runs of sorted values that lie at most ``gap`` apart."""
    w = Window.partitionBy("doc_id").orderBy(value)
    new = F.coalesce((F.col(value) - F.lag(value).over(w) > gap).cast("int"), F.lit(1))
    run = rows.withColumn("_new", new).withColumn("block", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return run.groupBy("doc_id", "block").agg(F.min(value).alias("first"), F.max(value).alias("last"), F.count("*").alias("n"))


def stable_runs(rows: DataFrame, value: str, order: list[str], least: int = 4) -> DataFrame:
    """doc_id, first, n: runs of equal consecutive readings with ``least`` unchanged comparisons or more."""
    w = Window.partitionBy("doc_id").orderBy(*order)
    new = F.coalesce((F.col(value) != F.lag(value).over(w)).cast("int"), F.lit(1))
    run = rows.withColumn("_new", new).withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return run.groupBy("doc_id", "_run").agg(F.min("ord").alias("first"), F.count("*").alias("n")).filter(F.col("n") > least).drop("_run")


def hue_span(hues: DataFrame) -> DataFrame:
    """doc_id, families, span: 30 degree families, and 360 less the widest gap around the circle."""
    w = Window.partitionBy("doc_id").orderBy("hue")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = F.coalesce(F.lead("hue").over(w), F.first("hue").over(whole) + 360.0)
    gaps = hues.withColumn("gap", following - F.col("hue"))
    return gaps.groupBy("doc_id").agg(F.countDistinct(F.floor(F.col("hue") / 30.0)).alias("families"), (360.0 - F.max("gap")).alias("span"), F.count("*").alias("colors"))


def series_variation(rows: DataFrame, value: str) -> DataFrame:
    from cardlens.functions.scalars import variation

    v = F.col(value).cast("double")
    sums = rows.groupBy("doc_id").agg(F.sum(v).alias("s"), F.sum(v * v).alias("q"), F.count(v).alias("n"))
    return sums.select("doc_id", F.col("n"), variation(F.col("s"), F.col("q"), F.col("n")).alias("cv"))
