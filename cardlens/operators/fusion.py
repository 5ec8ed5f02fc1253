"""From metric results and deductions to dimension scores, caps, calibration and grades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardlens.functions import scalars as S
from cardlens.sources.settings import DEFAULTS, Settings

CAP_FLOOR = 40.0
#: Severities in the order of weight.
SEVERITIES = ("high", "medium", "low")


def severity_rank(severity: Column) -> Column:
    return F.coalesce(F.array_position(F.array(*map(F.lit, SEVERITIES)), severity), F.lit(0)).cast("int")


def dimension_table(spark: SparkSession, settings: Settings = DEFAULTS) -> DataFrame:
    rows = [F.struct(F.lit(d).alias("dimension"), F.lit(w).alias("dimension_weight"), F.lit(i).alias("turn")) for i, (d, w) in enumerate(settings.dimensions.items())]
    return spark.range(1).select(F.inline(F.array(*rows)))


def dimension_scores(metrics: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """doc_id, dimension, score, dimension_weight: weighted average of the scored metrics.

    Every dimension of the table counts for every document; one without a scored metric of
    positive weight scores 0.
    """
    scored = F.col("score").isNotNull() & (F.col("weight") > 0)
    sums = metrics.groupBy("doc_id", "dimension").agg(F.sum(F.when(scored, F.col("score") * F.col("weight"))).alias("sw"), F.sum(F.when(scored, F.col("weight"))).alias("w"))
    # the dimension table has a fixed handful of rows
    every = metrics.select("doc_id").distinct().withColumn("d", F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.lit(w).alias("dimension_weight")) for d, w in settings.dimensions.items()])))
    every = every.select("doc_id", "d.dimension", "d.dimension_weight")
    out = every.join(sums, ["doc_id", "dimension"], "left")
    return out.select("doc_id", "dimension", F.coalesce(S.clamp(F.col("sw") / F.col("w")), F.lit(0.0)).alias("score"), "dimension_weight")


def _graded(rows: DataFrame, overall: Column, settings: Settings, *keys: str) -> DataFrame:
    calibrated = settings.calibrate(overall)
    return rows.select(*keys, overall.alias("overall"), calibrated.alias("calibrated"), settings.grade(calibrated).alias("grade"))


def overall_scores(metrics: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """doc_id, overall, calibrated, grade."""
    d = dimension_scores(metrics, settings).groupBy("doc_id").agg((F.sum(F.col("score") * F.col("dimension_weight")) / F.sum("dimension_weight")).alias("o"))
    overall = S.rounded(S.clamp(F.col("o")), 2)
    return _graded(d, overall, settings, "doc_id")


def confidence(metrics: DataFrame) -> DataFrame:
    """doc_id, confidence: the mean of the ok metrics less 0.08 for each error, within 0 and 1."""
    sums = metrics.groupBy("doc_id").agg(F.avg(F.when(F.col("status") == "ok", F.col("confidence"))).alias("c"), F.count_if(F.col("status") == "error").alias("e"))
    return sums.select("doc_id", S.rounded(S.clamp(F.coalesce("c", F.lit(0.0)) - 0.08 * F.col("e"), 0.0, 1.0), 4).alias("confidence"))


def merge_deductions(deductions: DataFrame) -> DataFrame:
    """One deduction for each (document, code, evidence): the largest, the first of equals; rank by
    severity, then size."""
    first = Window.partitionBy("doc_id", "code", "evidence").orderBy(F.desc(F.abs("delta")), "ord")
    kept = deductions.withColumn("n", F.row_number().over(first)).filter("n = 1").drop("n")
    order = Window.partitionBy("doc_id").orderBy(severity_rank(F.col("severity")), "delta", "ord")
    return kept.withColumn("rank", F.row_number().over(order).cast("long"))


def cap_of(code: Column, severity: Column, magnitude: Column, settings: Settings = DEFAULTS) -> Column:
    """The cap of a deduction, to the nearest half; null for codes without one and for low
    severity (but for low contrast)."""
    base, slope = F.lit(None).cast("double"), F.lit(None).cast("double")
    for name, (cap, s) in settings.caps.items():
        base, slope = F.when(code == name, cap).otherwise(base), F.when(code == name, s).otherwise(slope)
    sloped = F.greatest(F.lit(CAP_FLOOR), F.floor((base - slope * magnitude) * 2.0 + 0.5) / 2.0)
    counts = base.isNotNull() & ((severity != "low") | (code == "visual.low_contrast"))
    return F.when(counts, F.when(magnitude.isNull(), base).otherwise(sloped))


def hard_caps(deductions: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """doc_id, cap, codes, stacking, effective: the least cap, less 2 for each further code, 6 at most."""
    capped = merge_deductions(deductions).withColumn("cap", cap_of(F.col("code"), F.col("severity"), F.col("magnitude"), settings)).filter("cap IS NOT NULL")
    sums = capped.groupBy("doc_id").agg(F.min("cap").alias("cap"), F.countDistinct("code").alias("codes"))
    stacking = F.least(F.lit(6.0), 2.0 * (F.col("codes") - 1))
    return sums.select("doc_id", "cap", "codes", stacking.alias("stacking"), (F.col("cap") - stacking).alias("effective"))


def capped_overall(metrics: DataFrame, deductions: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """doc_id, raw, effective cap, overall, calibrated, grade."""
    raw = overall_scores(metrics, settings).select("doc_id", F.col("overall").alias("raw"))
    out = raw.join(hard_caps(deductions, settings).select("doc_id", "effective"), "doc_id", "left")
    overall = S.rounded(S.clamp(F.least("raw", "effective")), 2)
    return _graded(out, overall, settings, "doc_id", "raw", "effective")


def enriched(deductions: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Deductions as metrics report them, made whole: (doc_id, dimension, metric) and, each possibly null, (code, source,
    severity, delta, reason, evidence, fix_hint, prompt_hint, magnitude).

    A missing code is dimension.metric, a missing reason or hint comes from the code's template, a reason without one
    is the code. Empty texts count as missing. Other columns stay as they are.
    """
    given = lambda c: F.nullif(F.col(c), F.lit(""))
    code = F.coalesce(given("code"), F.concat_ws(".", "dimension", "metric"))
    out = deductions.withColumn("code", code)
    template = lambda k: settings.template(F.col("code"), k)
    return out.withColumns({
        "source": F.coalesce(given("source"), F.col("dimension")), "severity": F.coalesce(given("severity"), F.lit("low")), "delta": F.coalesce("delta", F.lit(0.0)),
        "reason": F.coalesce(given("reason"), template("reason"), F.col("code")), "evidence": F.coalesce("evidence", F.lit("")),
        "fix_hint": F.coalesce(given("fix_hint"), template("fix_hint"), F.lit("")), "prompt_hint": F.coalesce(given("prompt_hint"), template("prompt_hint"), F.lit("")),
    })


def generic_deductions(metrics: DataFrame, below: float = 65.0) -> DataFrame:
    """A deduction for each scored metric below ``below``: severity, delta, magnitude."""
    gap = below - F.col("score")
    return metrics.filter(F.col("score") < below).select(
        "doc_id", "dimension", "ord", F.when(F.col("score") < 50, "medium").otherwise("low").alias("severity"), (-S.rounded(gap / 4.0, 2)).alias("delta"), S.clamp(gap / below, 0.0, 1.0).alias("magnitude")
    )


def suggestions(deductions: DataFrame, most: int = 8) -> DataFrame:
    """doc_id, rank, hint: the distinct hints of a document in order, ``most`` at most."""
    first = merge_deductions(deductions).filter("hint != ''").groupBy("doc_id", "hint").agg(F.min("rank").alias("first"))
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy("first")).cast("long")
    return first.withColumn("rank", rank).filter(F.col("rank") <= most).select("doc_id", "rank", "hint")


def top_codes(deductions: DataFrame, most: int = 5) -> DataFrame:
    """doc_id, rank, code: the first ``most`` deductions by severity and size."""
    return merge_deductions(deductions).filter(F.col("rank") <= most).select("doc_id", "rank", "code")


def frequent_codes(deductions: DataFrame, most: int = 8) -> DataFrame:
    """code, n, evidence: the ``most`` commonest codes with the evidence seen first."""
    sums = deductions.groupBy("code").agg(F.count("*").alias("n"), F.min_by("evidence", "ord").alias("evidence"))
    return sums.orderBy(F.desc("n"), "code").limit(most)


def batch_statuses(metrics: DataFrame, deductions: DataFrame, batch: Column) -> DataFrame:
    """(batch, docs, high, medium, unsure, status) of the documents of each ``batch``.

    Deductions are counted by severity. Any high one fails a batch; else documents of low
    confidence ask for a review; else any medium one leaves a warning.
    """
    sums = deductions.groupBy("doc_id").agg(F.count_if(F.col("severity") == "high").alias("h"), F.count_if(F.col("severity") == "medium").alias("m"))
    docs = confidence(metrics).join(sums, "doc_id", "left").groupBy(batch.alias("batch"))
    out = docs.agg(F.count("*").alias("docs"), F.coalesce(F.sum("h"), F.lit(0)).alias("high"), F.coalesce(F.sum("m"), F.lit(0)).alias("medium"), F.count_if(F.col("confidence") < 0.8).alias("unsure"))
    status = F.when(F.col("high") > 0, "fail").when(F.col("unsure") > 0, "needs_review").when(F.col("medium") > 0, "pass_with_warnings").otherwise("pass")
    return out.withColumn("status", status)


def histogram(scores: DataFrame, score: str = "overall") -> DataFrame:
    """bin, turn, n for every bin, empty ones included."""
    bins = F.array(*[F.struct(F.lit(b).alias("bin"), F.lit(i).cast("long").alias("turn")) for i, b in enumerate(("90+", "80-90", "75-80", "70-75", "60-70", "<60"))])
    counts = scores.groupBy(S.bin_of(F.col(score)).alias("bin")).agg(F.count("*").alias("n"))
    return scores.sparkSession.range(1).select(F.inline(bins)).join(counts, "bin", "left").select("bin", "turn", F.coalesce("n", F.lit(0)).alias("n"))


def mean_median(scores: DataFrame, score: str = "overall") -> DataFrame:
    return scores.agg(F.count("*").alias("docs"), S.rounded(F.avg(score), 4).alias("mean"), F.percentile(score, 0.5).alias("median"), F.count_if(F.col(score) < 60).alias("below_60"))


def score_rows(metrics: DataFrame, deductions: DataFrame) -> DataFrame:
    """Nested summary rows: doc_id, overall, grade, dimensions (map), top_deductions (array)."""
    maps = dimension_scores(metrics).groupBy("doc_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("dimension", S.rounded(F.col("score"), 2))))).alias("dimensions"))
    tops = top_codes(deductions).groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "code"))), lambda x: x["code"]).alias("top_deductions"))
    return overall_scores(metrics).select("doc_id", "overall", "grade").join(maps, "doc_id").join(tops, "doc_id", "left")


def warnings(metrics: DataFrame) -> DataFrame:
    """doc_id, ord, warning: metrics of no weight, in error, or skipped."""
    kind = F.when(F.col("status") == "error", "metric failed").when(F.col("status") == "skipped", "metric skipped").when(F.col("weight") <= 0, "metric without weight")
    return metrics.withColumn("warning", kind).filter("warning IS NOT NULL").select("doc_id", "ord", "warning")
