"""Queries of score fusion, deductions and batch reports, with their oracles."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.functions import scalars as S
from cardlens.operators import fusion as U
from cardlens.operators.rounds import checkpoint_folder
from cardlens.plans.base import query, r
from cardlens.sources import adapters as A
from cardlens.sources.settings import SCHEMA, settings_of
from cardlens.sources.writers import commit_run, read_run, result_rows

_DIMS = ", ".join(f"('{d}', {w}e0)" for d, w, _ in A.DIMENSIONS)
DIMS = f"""m AS {A.METRICS}, e AS (SELECT doc_id, dimension, dw FROM (SELECT DISTINCT doc_id FROM m), (VALUES {_DIMS}) t(dimension, dw)),
s AS (SELECT doc_id, dimension, sum(score * weight) / sum(weight) AS a FROM m WHERE score IS NOT NULL AND weight > 0 GROUP BY 1, 2),
d AS (SELECT e.doc_id, e.dimension, coalesce(greatest(0.0e0, least(100.0e0, a)), 0.0e0) AS score, dw FROM e LEFT JOIN s ON s.doc_id = e.doc_id AND s.dimension = e.dimension)"""
OVERALL = f"{DIMS}, o AS (SELECT doc_id, {r('sum(score * dw) / sum(dw)', 2)} AS overall FROM d GROUP BY 1)"


def _cal(x: str) -> str:
    return f"(floor(greatest(0.0e0, least(100.0e0, 0.830716e0 * {x} + 11.831671e0)) * 2 + 0.5e0) / 2.0e0)"


def _grade(x: str) -> str:
    return f"CASE WHEN {x} >= 95 THEN 'S' WHEN {x} >= 90 THEN 'A+' WHEN {x} >= 85 THEN 'A' WHEN {x} >= 80 THEN 'B+' WHEN {x} >= 70 THEN 'B' WHEN {x} >= 60 THEN 'C' ELSE 'D' END"


MERGED = f"""ded AS {A.DEDUCTIONS}, f AS (SELECT *, row_number() OVER (PARTITION BY doc_id, code, evidence ORDER BY abs(delta) DESC, ord) AS n FROM ded),
g AS (SELECT doc_id, ord, code, severity, delta, evidence, magnitude, hint, row_number() OVER (PARTITION BY doc_id ORDER BY CASE severity WHEN 'high' THEN 1 WHEN 'medium' THEN 2 ELSE 3 END, delta, ord) AS rank FROM f WHERE n = 1)"""
_BASE = "CASE code " + " ".join(f"WHEN '{c}' THEN {b}e0" for c, b, _ in A.CODES if b) + " END"
_SLOPE = "CASE code " + " ".join(f"WHEN '{c}' THEN {s}e0" for c, b, s in A.CODES if b) + " END"
CAPS = f"""{MERGED}, c AS (SELECT doc_id, code, CASE WHEN magnitude IS NULL THEN {_BASE} ELSE greatest(40.0e0, floor(({_BASE} - {_SLOPE} * magnitude) * 2 + 0.5e0) / 2.0e0) END AS cap FROM g
 WHERE ({_BASE}) IS NOT NULL AND (severity <> 'low' OR code = 'visual.low_contrast')),
h AS (SELECT doc_id, min(cap) AS cap, count(DISTINCT code) AS codes, least(6.0e0, 2.0e0 * (count(DISTINCT code) - 1)) AS stacking FROM c GROUP BY 1)"""


@query(f"WITH {OVERALL} SELECT doc_id, overall, {_cal('overall')} AS calibrated, {_grade(_cal('overall'))} AS grade FROM o")
def fusion_overall(spark, sf) -> DataFrame:
    return U.overall_scores(A.metric_facts(spark, sf))


@query(f"WITH {DIMS} SELECT doc_id, dimension, {r('score')} AS score, dw AS dimension_weight FROM d")
def fusion_dimensions(spark, sf) -> DataFrame:
    return U.dimension_scores(A.metric_facts(spark, sf)).withColumn("score", S.rounded(F.col("score")))


@query(f"""WITH m AS {A.METRICS} SELECT doc_id, {r("greatest(0.0e0, least(1.0e0, coalesce(avg(confidence) FILTER (WHERE status = 'ok'), 0.0e0) - 0.08e0 * count(*) FILTER (WHERE status = 'error')))")} AS confidence FROM m GROUP BY 1""")
def fusion_confidence(spark, sf) -> DataFrame:
    return U.confidence(A.metric_facts(spark, sf))


@query(f"WITH {MERGED} SELECT * FROM g")
def deductions_merge(spark, sf) -> DataFrame:
    return U.merge_deductions(A.deduction_facts(spark, sf))


@query(f"WITH {CAPS} SELECT doc_id, cap, codes, stacking, cap - stacking AS effective FROM h")
def hard_caps(spark, sf) -> DataFrame:
    return U.hard_caps(A.deduction_facts(spark, sf))


@query(f"""WITH {OVERALL}, {CAPS}, k AS (SELECT o.doc_id, overall AS raw, cap - stacking AS effective, {r('greatest(0.0e0, least(100.0e0, least(overall, coalesce(cap - stacking, overall))))', 2)} AS x FROM o LEFT JOIN h USING (doc_id))
SELECT doc_id, raw, effective, x AS overall, {_cal('x')} AS calibrated, {_grade(_cal('x'))} AS grade FROM k""")
def capped_overall(spark, sf) -> DataFrame:
    return U.capped_overall(A.metric_facts(spark, sf), A.deduction_facts(spark, sf))


@query(f"""WITH m AS {A.METRICS} SELECT doc_id, dimension, ord, CASE WHEN score < 50 THEN 'medium' ELSE 'low' END AS severity, -{r('(65 - score) / 4', 2)} AS delta, {r('(65 - score) / 65')} AS magnitude FROM m WHERE score < 65""")
def generic_deductions(spark, sf) -> DataFrame:
    return U.generic_deductions(A.metric_facts(spark, sf)).withColumn("magnitude", S.rounded(F.col("magnitude")))


@query(f"WITH {MERGED}, t AS (SELECT doc_id, hint, min(rank) AS first FROM g WHERE hint <> '' GROUP BY 1, 2), u AS (SELECT doc_id, hint, row_number() OVER (PARTITION BY doc_id ORDER BY first) AS rank FROM t) SELECT doc_id, rank, hint FROM u WHERE rank <= 8")
def prompt_suggestions_topk(spark, sf) -> DataFrame:
    return U.suggestions(A.deduction_facts(spark, sf))


@query(f"WITH {MERGED} SELECT doc_id, rank, code FROM g WHERE rank <= 5")
def top_deduction_codes(spark, sf) -> DataFrame:
    return U.top_codes(A.deduction_facts(spark, sf))


@query(f"WITH ded AS {A.DEDUCTIONS} SELECT code, count(*) AS n, arg_min(evidence, ord) AS evidence FROM ded GROUP BY 1 ORDER BY n DESC, code LIMIT 8")
def frequent_deductions(spark, sf) -> DataFrame:
    return U.frequent_codes(A.deduction_facts(spark, sf))


@query(f"""WITH m AS {A.METRICS}, ded AS {A.DEDUCTIONS}, c AS (SELECT doc_id, {r("greatest(0.0e0, least(1.0e0, coalesce(avg(confidence) FILTER (WHERE status = 'ok'), 0.0e0) - 0.08e0 * count(*) FILTER (WHERE status = 'error')))")} AS confidence FROM m GROUP BY 1),
d AS (SELECT doc_id, count(*) FILTER (WHERE severity = 'high') AS h, count(*) FILTER (WHERE severity = 'medium') AS m FROM ded GROUP BY 1),
s AS (SELECT c.doc_id // 2 AS batch, count(*) AS docs, CAST(coalesce(sum(h), 0) AS BIGINT) AS high, CAST(coalesce(sum(m), 0) AS BIGINT) AS medium, count(*) FILTER (WHERE confidence < 0.8e0) AS unsure FROM c LEFT JOIN d USING (doc_id) GROUP BY 1)
SELECT *, CASE WHEN high > 0 THEN 'fail' WHEN unsure > 0 THEN 'needs_review' WHEN medium > 0 THEN 'pass_with_warnings' ELSE 'pass' END AS status FROM s""")
def batch_statuses(spark, sf) -> DataFrame:
    """Batches of two documents: enough of them for each of the four states."""
    return U.batch_statuses(A.metric_facts(spark, sf), A.deduction_facts(spark, sf), F.floor(F.col("doc_id") / 2))


_BIN = "CASE WHEN overall >= 90 THEN '90+' WHEN overall >= 80 THEN '80-90' WHEN overall >= 75 THEN '75-80' WHEN overall >= 70 THEN '70-75' WHEN overall >= 60 THEN '60-70' ELSE '<60' END"


@query(f"""WITH {OVERALL} SELECT b.bin, b.turn, coalesce(n, 0) AS n FROM (VALUES ('90+', 0::BIGINT), ('80-90', 1), ('75-80', 2), ('70-75', 3), ('60-70', 4), ('<60', 5)) b(bin, turn)
LEFT JOIN (SELECT {_BIN} AS bin, count(*) AS n FROM o GROUP BY 1) USING (bin)""")
def score_histogram(spark, sf) -> DataFrame:
    return U.histogram(U.overall_scores(A.metric_facts(spark, sf)))


@query(f"WITH {OVERALL} SELECT count(*) AS docs, {r('avg(overall)')} AS mean, median(overall) AS median, count(*) FILTER (WHERE overall < 60) AS below_60 FROM o")
def score_mean_median(spark, sf) -> DataFrame:
    return U.mean_median(U.overall_scores(A.metric_facts(spark, sf)))


@query(f"""WITH {OVERALL}, {MERGED.replace('\ng AS', '\ngg AS')}, x AS (SELECT doc_id, string_agg(dimension || '=' || {r('score', 2)}, ',' ORDER BY dimension) AS dimensions FROM d GROUP BY 1),
t AS (SELECT doc_id, string_agg(code, ',' ORDER BY rank) AS top_deductions FROM gg WHERE rank <= 5 GROUP BY 1)
SELECT o.doc_id, overall, {_grade(_cal('overall'))} AS grade, dimensions, top_deductions FROM o JOIN x USING (doc_id) LEFT JOIN t USING (doc_id)""")
def score_rows_nested(spark, sf) -> DataFrame:
    out = U.score_rows(A.metric_facts(spark, sf), A.deduction_facts(spark, sf))
    flat = F.array_join(F.transform(F.map_entries("dimensions"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return out.withColumn("dimensions", flat).withColumn("top_deductions", F.array_join("top_deductions", ","))


@query(f"""WITH {OVERALL}, {MERGED.replace('\ng AS', '\ngg AS')} SELECT doc_id, overall FROM o WHERE contains(CAST(doc_id AS VARCHAR), '1') AND {_grade(_cal('overall'))} = 'D'
AND doc_id IN (SELECT doc_id FROM gg WHERE code = 'layout.overlap')""")
def gallery_filter(spark, sf) -> DataFrame:
    """Documents whose id holds "1", of grade D, with an overlap."""
    codes = U.merge_deductions(A.deduction_facts(spark, sf)).filter("code = 'layout.overlap'").select("doc_id")
    scores = U.overall_scores(A.metric_facts(spark, sf))
    return scores.filter(F.col("doc_id").cast("string").contains("1") & (F.col("grade") == "D")).join(codes, "doc_id", "left_semi").select("doc_id", "overall")


@query(f"""WITH m AS {A.METRICS}, w AS (SELECT doc_id, ord, CASE WHEN status = 'error' THEN 'metric failed' WHEN status = 'skipped' THEN 'metric skipped' WHEN weight <= 0 THEN 'metric without weight' END AS warning FROM m)
SELECT * FROM w WHERE warning IS NOT NULL""")
def fusion_warnings(spark, sf) -> DataFrame:
    return U.warnings(A.metric_facts(spark, sf))


SETTINGS = [
    ("dimension", "geometry", "weight", "1"), ("dimension", "visual", "weight", "3"), ("calibration", None, "a", "1"), ("calibration", None, "b", "-5"), ("grade", "good", "minimum", "40"), ("grade", "fair", "minimum", "20"),
    ("cap", "layout.overlap", "base", "50"), ("cap", "layout.overlap", "slope", "8"), ("template", "layout.overlap", "reason", "parts overlap"), ("template", "layout.overlap", "fix_hint", "move them apart"),
    ("template", "visual.contrast", "prompt_hint", "use darker ink"),
]


_SET = f"""m AS {A.METRICS}, s AS (SELECT doc_id, dimension, greatest(0.0e0, least(100.0e0, sum(score * weight) / sum(weight))) AS a FROM m WHERE score IS NOT NULL AND weight > 0 AND dimension IN ('geometry', 'visual') GROUP BY 1, 2),
o AS (SELECT d.doc_id, {r("(coalesce(g.a, 0) * 1 + coalesce(v.a, 0) * 3) / 4", 2)} AS raw FROM (SELECT DISTINCT doc_id FROM m) d LEFT JOIN s g ON g.doc_id = d.doc_id AND g.dimension = 'geometry' LEFT JOIN s v ON v.doc_id = d.doc_id AND v.dimension = 'visual'),
{MERGED}, c AS (SELECT doc_id, min(CASE WHEN magnitude IS NULL THEN 50.0e0 ELSE greatest(40.0e0, floor((50 - 8 * magnitude) * 2 + 0.5e0) / 2.0e0) END) AS effective FROM g WHERE code = 'layout.overlap' AND severity <> 'low' GROUP BY 1),
t AS (SELECT doc_id, raw, effective, {r("greatest(0.0e0, least(raw, effective))", 2)} AS overall FROM o LEFT JOIN c USING (doc_id)),
k AS (SELECT *, floor(greatest(0.0e0, least(100.0e0, overall - 5)) * 2 + 0.5e0) / 2.0e0 AS calibrated FROM t)"""


@query(f"WITH {_SET} SELECT *, CASE WHEN calibrated >= 40 THEN 'good' WHEN calibrated >= 20 THEN 'fair' ELSE 'D' END AS grade FROM k")
def configured_scores(spark, sf) -> DataFrame:
    """Scores under settings from a table: two dimensions, one cap, another calibration and other grades."""
    settings = settings_of(spark.createDataFrame(SETTINGS, SCHEMA))
    return U.capped_overall(A.metric_facts(spark, sf), A.deduction_facts(spark, sf), settings)


_HEAD = "CASE WHEN ord % 3 = 0 THEN 'visual.contrast' ELSE code END"


@query(f"""WITH d AS {A.DEDUCTIONS}, k AS (SELECT *, {_HEAD} AS c FROM d) SELECT doc_id, ord, c AS code, 'visual' AS source, CASE WHEN ord % 4 = 0 THEN 'low' ELSE severity END AS severity,
CASE WHEN ord % 5 = 0 THEN 'as measured' WHEN c = 'layout.overlap' THEN 'parts overlap' ELSE c END AS reason, CASE WHEN c = 'layout.overlap' THEN 'move them apart' ELSE '' END AS fix_hint,
CASE WHEN hint <> '' THEN hint WHEN c = 'visual.contrast' THEN 'use darker ink' ELSE '' END AS prompt_hint FROM k""")
def enriched_deductions(spark, sf) -> DataFrame:
    """Deductions of which some lack a code, a severity, a reason or hints, made whole by templates."""
    rows = A.deduction_facts(spark, sf).withColumns({
        "dimension": F.lit("visual"), "metric": F.lit("contrast"), "source": F.lit(None).cast("string"), "code": F.when(F.col("ord") % 3 != 0, F.col("code")), "severity": F.when(F.col("ord") % 4 != 0, F.col("severity")),
        "reason": F.when(F.col("ord") % 5 == 0, "as measured"), "fix_hint": F.lit(""), "prompt_hint": F.col("hint"),
    })
    out = U.enriched(rows, settings_of(spark.createDataFrame(SETTINGS, SCHEMA)))
    return out.select("doc_id", "ord", "code", "source", "severity", "reason", "fix_hint", "prompt_hint")


@query(f"""WITH {OVERALL}, {CAPS}, f2 AS (SELECT o.doc_id, {r("greatest(0.0e0, least(o.overall, h.cap - h.stacking))", 2)} AS overall FROM o LEFT JOIN h ON h.doc_id = o.doc_id), t AS (SELECT doc_id, list(code ORDER BY rank) AS codes FROM g WHERE rank <= 5 GROUP BY 1)
SELECT doc_id, overall, {_grade(_cal('overall'))} AS grade, array_to_string(codes, ',') AS top_deductions FROM f2 LEFT JOIN t USING (doc_id)""")
def committed_scores(spark, sf) -> DataFrame:
    """The score rows of a committed run, written and read back."""
    path = f"{checkpoint_folder(spark)}/runs-{uuid.uuid4().hex}"
    commit_run(result_rows(A.metric_facts(spark, sf), A.deduction_facts(spark, sf)), path, "1")
    out = read_run(spark, path, "1", "scores", "doc_id long, overall double, raw double, calibrated double, grade string, top_deductions array<string>")
    return out.select("doc_id", "overall", "grade", F.array_join("top_deductions", ",").alias("top_deductions"))
