"""Queries of spatial joins and of the metric registry, with their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.functions.scalars import rounded
from cardlens.operators import fusion as U
from cardlens.operators import metrics as M
from cardlens.operators import surfaces as Q
from cardlens.plans import evidence  # noqa: F401  (its oracles are read below)
from cardlens.plans import geometry as PG
from cardlens.plans.base import ORACLES, query, r
from cardlens.sources import adapters as A

B = f"WITH b AS {A.BOXES}"


@query(f"""{B} SELECT o.doc_id, o.ord, count(t.ord) AS texts FROM b o LEFT JOIN b t ON t.doc_id = o.doc_id AND t.kind = 'text' AND t.x + t.w / 2 BETWEEN o.x AND o.x + o.w AND t.y + t.h / 2 BETWEEN o.y AND o.y + o.h
WHERE o.kind <> 'text' GROUP BY 1, 2""")
def texts_inside(spark, sf) -> DataFrame:
    return Q.texts_inside(A.boxes(spark, sf))


@query(f"""{B} SELECT p.doc_id, p.ord FROM b p WHERE p.kind <> 'text' AND NOT EXISTS (SELECT 1 FROM b q WHERE q.doc_id = p.doc_id AND q.kind = 'text'
AND {PG._IOU} / (p.w * p.h + q.w * q.h - {PG._IOU}) > 0.1e0)""")
def without_text_doubles(spark, sf) -> DataFrame:
    return Q.without_text_doubles(A.boxes(spark, sf), 0.1)


@query(f"""{B}, d AS (SELECT p.doc_id, p.ord AS a, q.ord AS b, greatest(q.x - p.x - p.w, p.x - q.x - q.w) AS dx, greatest(q.y - p.y - p.h, p.y - q.y - q.h) AS dy FROM b p JOIN b q ON p.doc_id = q.doc_id AND p.ord < q.ord WHERE p.radius > 0 AND q.radius > 0),
g AS (SELECT doc_id, a, b, CASE WHEN dx >= 0 AND dy < 0 THEN dx WHEN dy >= 0 AND dx < 0 THEN dy END AS gap FROM d) SELECT * FROM g WHERE gap <= 2""")
def touching_surfaces(spark, sf) -> DataFrame:
    return Q.touching_pairs(A.boxes(spark, sf), 2.0)


@query(f"""{B}, s AS (SELECT doc_id, ord, x, y, CASE kind WHEN 'button' THEN 100.0e0 WHEN 'image' THEN 40.0e0 ELSE 0.0e0 END + least(w, h) AS score FROM b),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, y DESC, x, ord) AS n FROM s) SELECT doc_id, ord, score FROM k WHERE n = 1""")
def control_locator_argmax(spark, sf) -> DataFrame:
    return Q.best_control(A.boxes(spark, sf))


@query(f"""{B} SELECT doc_id, ord, CAST(x AS BIGINT) AS l, CAST(x + w AS BIGINT) AS r FROM b WHERE ord % 4 <> 0""")
def bounds_parse(spark, sf) -> DataFrame:
    """Bounds written as text and parsed again; every fourth is cut off and has none."""
    i = lambda c: F.col(c).cast("long").cast("string")
    text = F.concat(F.lit("["), i("x"), F.lit(","), i("y"), F.lit("]["), (F.col("x") + F.col("w")).cast("long").cast("string"))
    whole = F.concat(text, F.lit(","), (F.col("y") + F.col("h")).cast("long").cast("string"), F.lit("]"))
    rows = A.boxes(spark, sf).withColumn("p", Q.parse_bounds(F.when(F.col("ord") % 4 != 0, whole).otherwise(text)))
    return rows.filter("p IS NOT NULL").select("doc_id", "ord", "p.l", "p.r")


#: Registered metric: the oracle that holds its score, and the column.
_FROM = {
    ("geometry", "whitespace"): ("union_area_density", "whitespace_score"), ("geometry", "density"): ("union_area_density", "density_score"), ("geometry", "padding"): ("padding_metric", "score"),
    ("geometry", "alignment"): ("snap_alignment", "score"), ("geometry", "grid"): ("grid_snap_best", "score"), ("geometry", "overlap"): ("overlap_metric", "score"),
    ("geometry", "spacing_rhythm"): ("vertical_gap_rhythm", "score"), ("geometry", "typography_hierarchy"): ("typography_levels", "score"), ("layout", "margin_consistency"): ("margin_consistency", "score"),
    ("layout", "overflow"): ("overflow_metric", "score"), ("visual", "contrast"): ("contrast_sigmoid", "score"), ("consistency", "grid"): ("edge_grid", "score"),
}
_LONG = " UNION ALL ".join(
    f"SELECT doc_id, '{d}' AS dimension, '{n}' AS name, {M.METRICS[d, n][0]}e0 AS weight, {c} AS score, CASE WHEN {c} IS NULL THEN 'skipped' ELSE 'ok' END AS status FROM ({ORACLES[o]})" for (d, n), (o, c) in _FROM.items()
)


#: The other registered metrics of boxes.
_MORE = {
    ("visual", "visual_focus"): ("visual_focus_balance", "focus_score"), ("visual", "visual_balance"): ("visual_focus_balance", "balance_score"), ("visual", "text_image_ratio"): ("text_image_ratio", "ratio_score"),
    ("visual", "sparse_text_stack"): ("text_image_ratio", "sparse_score"), ("consistency", "component_size"): ("consistency_metrics", "component_size"),
    ("consistency", "corner_radius_consistency"): ("consistency_metrics", "corner_radius"), ("consistency", "padding_consistency"): ("consistency_metrics", "padding"),
    ("consistency", "icon_size_consistency"): ("consistency_metrics", "icon_size"), ("layout", "whitespace"): ("layout_area", "whitespace_score"), ("layout", "density"): ("layout_area", "density_score"),
    ("layout", "spacing_rhythm"): ("layout_spacing", "score"), ("consistency", "alignment"): ("consistency_alignment", "score"), ("consistency", "typography_rhythm"): ("typography_rhythm", "score"),
}
# cards without text score 0 there
_TEXT = {("visual", "reading_flow"): "reading_flow", ("visual", "hierarchy"): "gini_hierarchy"}
_SCORES = {k: f"SELECT doc_id, {c} AS score FROM ({ORACLES[o]})" for k, (o, c) in (_FROM | _MORE).items()}
_SCORES |= {k: f"SELECT d.doc_id, coalesce(score, 0.0e0) AS score FROM (SELECT DISTINCT l_orderkey AS doc_id FROM lineitem) d LEFT JOIN ({ORACLES[o]}) t ON t.doc_id = d.doc_id" for k, o in _TEXT.items()}
_SCORES["layout", "overlap"] = f"""{B}, {PG._pairs('2.0e0')}, m AS (SELECT d.doc_id, d.n, coalesce(p.m, 0.0e0) AS m FROM (SELECT doc_id, count(*) AS n FROM b GROUP BY 1) d LEFT JOIN (SELECT doc_id, max(iou) AS m FROM pairs GROUP BY 1) p USING (doc_id))
SELECT doc_id, CASE WHEN n >= 2 THEN {r('greatest(0.0e0, 100 - 100 * m)')} END AS score FROM m"""
_ALL = " UNION ALL ".join(
    f"SELECT doc_id, '{d}' AS dimension, '{n}' AS name, {M.METRICS[d, n][0]}e0 AS weight, score, CASE WHEN score IS NULL THEN 'skipped' ELSE 'ok' END AS status FROM ({sql})" for (d, n), sql in _SCORES.items()
)
#: Metrics whose scores have two digits in the SQL that they come from; the others have four.
_TWO = [n for (d, n), (o, _) in _MORE.items() if o in ("visual_focus_balance", "text_image_ratio", "consistency_metrics")] + ["reading_flow", "hierarchy"]


@query(_ALL)
def metric_results(spark, sf) -> DataFrame:
    """Every registered metric of boxes for every card, as one tidy table."""
    score = F.col("score")
    return M.run_metrics(A.boxes(spark, sf)).withColumn("score", F.when(F.col("name").isin(_TWO), rounded(score, 2)).otherwise(rounded(score)))


@query(f"""SELECT doc_id, {r('sum(round(score * 10000) * weight) / sum(weight) / 10000', 2)} AS geometry FROM ({_LONG}) WHERE dimension = 'geometry' AND score IS NOT NULL GROUP BY 1""")
def geometry_dimension(spark, sf) -> DataFrame:
    """The geometry dimension of every card, from boxes to score; sums are of whole numbers, so exact."""
    geometry = [k for k in _FROM if k[0] == "geometry"]
    results = M.run_metrics(A.boxes(spark, sf), geometry).filter("score IS NOT NULL")
    whole = F.sum(F.round(rounded(F.col("score")) * 10000) * F.col("weight")) / F.sum("weight") / 10000
    return results.groupBy("doc_id").agg(rounded(whole, 2).alias("geometry"))


@query()
def card_grades(spark, sf) -> DataFrame:
    """Grades of all cards from every registered metric."""
    return U.overall_scores(M.run_metrics(A.boxes(spark, sf)))
