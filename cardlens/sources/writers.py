"""Results on disk: a run is committed once, whole, by a rename.

A run is a folder ``<path>/run=<id>`` of JSON lines in as many files as Spark has tasks (``results``: one
document a line, ``scores``: one summary row a line) and a ``summary`` of one line. All of it is written to a staging
folder first; the rename at the end makes it visible. A run that is there already is left alone, so a
repeated or restarted job gives the same files, and a failed one leaves no run.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.operators import fusion as U


def result_rows(metrics: DataFrame, deductions: DataFrame) -> DataFrame:
    """(doc_id, overall, calibrated, grade, confidence, dimensions, deductions, caps): all that is known of a document.

    Deductions come merged and in the order of their rank. Documents without deductions have an empty list; deductions
    of documents without metrics are left out.
    """
    scores = U.capped_overall(metrics, deductions).select("doc_id", "raw", "overall", "calibrated", "grade", F.col("effective").alias("cap"))
    kept = U.merge_deductions(deductions)
    lists = kept.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("rank", "code", "severity", "delta", "evidence", "magnitude"))).alias("deductions"))
    dims = U.dimension_scores(metrics).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("dimension", "score"))).alias("dimensions"))
    out = scores.join(U.confidence(metrics), "doc_id").join(dims, "doc_id").join(lists, "doc_id", "left")
    none = F.array().cast(lists.schema["deductions"].dataType)
    return out.withColumn("deductions", F.coalesce("deductions", none))


def summary_row(results: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """One row on a batch of ``result_rows``: documents, missing ones of ``wanted`` (doc_id), severities, mean and
    extremes of the overall score, documents by grade."""
    each = lambda s: F.size(F.filter("deductions", lambda d: d["severity"] == s))
    severities = [F.sum(each(s)).alias(s) for s in U.SEVERITIES]
    unsure, ends = F.count_if(F.col("confidence") < 0.8).alias("unsure"), (F.min("overall").alias("least"), F.max("overall").alias("most"))
    rows = results.groupBy("grade").agg(F.count("*").alias("docs"), *severities, unsure, F.sum("overall").alias("total"), *ends).withColumn("missing", F.lit(0).cast("long"))
    if wanted is not None:
        gone = wanted.select("doc_id").distinct().join(results.select("doc_id"), "doc_id", "left_anti").agg(F.count("*").alias("missing"))
        rows = rows.unionByName(gone, allowMissingColumns=True)
    # a row a grade, and one on missing documents
    counts = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("docs", *U.SEVERITIES, "unsure", "missing")]
    mean = F.round(F.try_divide(F.sum("total"), F.sum("docs")), 4).alias("mean")
    grades = F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("grade").isNotNull(), F.struct("grade", F.col("docs").alias("n")))))).alias("grades")
    return rows.agg(*counts, mean, F.min("least").alias("least"), F.max("most").alias("most"), grades)


def _files(spark: SparkSession, path: str):
    """The file system of ``path``, and a maker of its paths."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    return hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()), hadoop.Path


def commit_run(results: DataFrame, path: str, run: str, wanted: DataFrame | None = None) -> str:
    """Write ``result_rows`` as a run below ``path``; its folder. See the module on reruns."""
    spark = results.sparkSession
    final, staged = f"{path}/run={run}", f"{path}/_staged-{uuid.uuid4().hex}"
    fs, at = _files(spark, path)
    if fs.exists(at(final)):
        return final
    try:
        results.write.json(f"{staged}/results")
        read = spark.read.schema(results.schema).json(f"{staged}/results")
        top = F.transform(F.slice("deductions", 1, 5), lambda d: d["code"])
        read.select("doc_id", "overall", "raw", "calibrated", "grade", top.alias("top_deductions")).write.json(f"{staged}/scores")
        summary_row(read, wanted).coalesce(1).write.json(f"{staged}/summary")
        fs.mkdirs(at(path))
        # a second writer of the same run may have been faster: rename into a folder that exists must not nest
        if not fs.exists(at(final)):
            fs.rename(at(staged), at(final))
    finally:
        if fs.exists(at(staged)):
            fs.delete(at(staged), True)
    return final


def read_run(spark: SparkSession, path: str, run: str, part: str = "results", schema: str | None = None) -> DataFrame:
    """A part of a run: ``results``, ``scores`` or ``summary``."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(f"{path}/run={run}/{part}")
