"""Queries of the geometry, layout, visual and consistency metrics, with their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.functions.scalars import rounded
from cardlens.operators import geometry as G
from cardlens.plans.base import query, r, gauss, band
from cardlens.sources import adapters as A

B = f"WITH b AS {A.BOXES}"
_IOU = "greatest(0.0e0, least(p.x + p.w, q.x + q.w) - greatest(p.x, q.x)) * greatest(0.0e0, least(p.y + p.h, q.y + q.h) - greatest(p.y, q.y))"


def _in(o: str, i: str, t: str) -> str:
    return f"({i}.x >= {o}.x - {t} AND {i}.y >= {o}.y - {t} AND {i}.x + {i}.w <= {o}.x + {o}.w + {t} AND {i}.y + {i}.h <= {o}.y + {o}.h + {t})"


def _pairs(t: str) -> str:
    return f"""pairs AS (SELECT doc_id, a, b, a_kind, b_kind, s / (pa + qa - s) AS iou FROM (
  SELECT p.doc_id, p.ord AS a, q.ord AS b, p.kind AS a_kind, q.kind AS b_kind, {_IOU} AS s, p.w * p.h AS pa, q.w * q.h AS qa
  FROM b p JOIN b q ON p.doc_id = q.doc_id AND p.ord < q.ord WHERE NOT {_in('p', 'q', t)} AND NOT {_in('q', 'p', t)}) WHERE s > 0)"""


_UNION = """c AS (SELECT doc_id, greatest(x, 0.0e0) AS x1, greatest(y, 0.0e0) AS y1, least(x + w, 160.0e0) AS x2, least(y + h, 160.0e0) AS y2 FROM b),
k AS (SELECT * FROM c WHERE x2 > x1 AND y2 > y1),
xs AS (SELECT DISTINCT doc_id, v FROM (SELECT doc_id, x1 AS v FROM k UNION ALL SELECT doc_id, x2 FROM k)),
ys AS (SELECT DISTINCT doc_id, v FROM (SELECT doc_id, y1 AS v FROM k UNION ALL SELECT doc_id, y2 FROM k)),
xc AS (SELECT doc_id, v AS l, lead(v) OVER (PARTITION BY doc_id ORDER BY v) AS r FROM xs),
yc AS (SELECT doc_id, v AS t, lead(v) OVER (PARTITION BY doc_id ORDER BY v) AS o FROM ys),
cells AS (SELECT xc.doc_id, l, r, t, o FROM xc JOIN yc ON xc.doc_id = yc.doc_id WHERE r IS NOT NULL AND o IS NOT NULL),
cov AS (SELECT doc_id, sum((r - l) * (o - t)) AS area FROM cells WHERE EXISTS (SELECT 1 FROM k WHERE k.doc_id = cells.doc_id AND x1 <= l AND x2 >= r AND y1 <= t AND y2 >= o) GROUP BY doc_id),
u AS (SELECT d.doc_id, coalesce(area, 0.0e0) AS area FROM (SELECT DISTINCT doc_id FROM b) d LEFT JOIN cov USING (doc_id))"""


def _cv(s: str, sq: str, n: str) -> str:
    return f"(CASE WHEN {n} < 2 OR abs({s} / {n}) < 1e-9 THEN 0.0e0 ELSE abs(sqrt(greatest({sq} / {n} - ({s} / {n}) * ({s} / {n}), 0.0e0)) / ({s} / {n})) END)"


@query(f"{B}, {_pairs('1.0e0')} SELECT doc_id, a, b, a_kind, b_kind, {r('iou', 6)} AS iou FROM pairs")
def box_iou_pairs(spark, sf) -> DataFrame:
    return G.iou_pairs(A.boxes(spark, sf)).withColumn("iou", rounded(F.col("iou"), 6))


@query(f"""{B}, {_pairs('1.0e0')}, m AS (SELECT d.doc_id, d.n, coalesce(p.m, 0.0e0) AS m FROM (SELECT doc_id, count(*) AS n FROM b GROUP BY 1) d LEFT JOIN (SELECT doc_id, max(iou) AS m FROM pairs GROUP BY 1) p USING (doc_id))
SELECT doc_id, {r('m', 6)} AS max_iou, CASE WHEN n >= 2 THEN {r('greatest(0.0e0, 100 - 180 * m)')} END AS score, CASE WHEN m >= 0.12e0 THEN 'high' WHEN m >= 0.04e0 THEN 'medium' END AS severity,
{r('least(1.0e0, m / 0.25e0)')} AS magnitude FROM m""")
def overlap_metric(spark, sf) -> DataFrame:
    out = G.overlap_scores(A.boxes(spark, sf))
    return out.select("doc_id", rounded(F.col("max_iou"), 6).alias("max_iou"), rounded(F.col("score")).alias("score"), "severity", rounded(F.col("magnitude")).alias("magnitude"))


@query(f"""{B}, {_pairs('2.0e0')}, k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY iou DESC, a, b) AS rk FROM pairs),
g AS (SELECT doc_id, max(iou) AS m, bool_or(iou >= 0.08e0 AND (a_kind IN ('text','button') OR b_kind IN ('text','button'))) AS imp,
 bool_or(iou >= 0.2e0 OR (iou >= 0.08e0 AND a_kind = 'button' AND b_kind = 'button')) AS sev, string_agg(a_kind || '-' || b_kind, ', ' ORDER BY rk) FILTER (WHERE rk <= 3) AS pairs FROM k GROUP BY 1)
SELECT doc_id, CASE WHEN sev THEN 'high' ELSE 'medium' END AS severity, {r('-greatest(6.0e0, m * 100)', 2)} AS delta, {r('least(1.0e0, m / 0.25e0)')} AS magnitude, pairs FROM g WHERE m >= 0.08e0 OR imp""")
def layout_overlap_deductions(spark, sf) -> DataFrame:
    out = G.layout_overlap_deductions(A.boxes(spark, sf))
    return out.withColumn("delta", rounded(F.col("delta"), 2)).withColumn("magnitude", rounded(F.col("magnitude")))


@query(f"""{B}, {_UNION} SELECT doc_id, {r('area / 25600')} AS density, {r(band('area / 25600', 0.28, 0.82, 0.12, 0.18))} AS density_score, {r(band('(1 - area / 25600)', 0.18, 0.72, 0.12, 0.16))} AS whitespace_score FROM u""")
def union_area_density(spark, sf) -> DataFrame:
    out = G.density_scores(A.boxes(spark, sf))
    return out.select("doc_id", *[rounded(F.col(c)).alias(c) for c in out.columns[1:]])


@query(f"""{B}, s AS (SELECT doc_id, sum(w * h) AS total, sum(w * h - greatest(0.0e0, least(x + w, 160.0e0) - greatest(x, 0.0e0)) * greatest(0.0e0, least(y + h, 160.0e0) - greatest(y, 0.0e0))) AS o FROM b GROUP BY 1)
SELECT doc_id, {r('o / total')} AS outside, {r('greatest(0.0e0, 100 - 100 * o / total)')} AS score FROM s""")
def overflow_metric(spark, sf) -> DataFrame:
    out = G.overflow_scores(A.boxes(spark, sf))
    return out.select("doc_id", rounded(F.col("outside")).alias("outside"), rounded(F.col("score")).alias("score"))


@query(f"""{B}, m AS (SELECT doc_id, greatest(0.0e0, min(x)) AS l, greatest(0.0e0, min(y)) AS t, greatest(0.0e0, min(160 - (x + w))) AS r, greatest(0.0e0, min(160 - (y + h))) AS o FROM b GROUP BY 1)
SELECT doc_id, {r('100 * exp(-2.2e0 * ' + _cv('(l + t + r + o)', '(l * l + t * t + r * r + o * o)', '4') + ')')} AS score, least(l, t, r, o) < 8 AS too_close FROM m""")
def padding_metric(spark, sf) -> DataFrame:
    return G.padding_scores(A.boxes(spark, sf)).withColumn("score", rounded(F.col("score")))


@query(f"""{B}, v AS (SELECT doc_id, unnest([x, y, 160 - (x + w), 160 - (y + h)]) AS v FROM b), s AS (SELECT doc_id, sum(v) AS s, sum(v * v) AS q, count(*) AS n FROM v WHERE v >= 0 GROUP BY 1)
SELECT d.doc_id, CASE WHEN n > 0 THEN {r('100 * exp(-2.4e0 * ' + _cv('s', 'q', 'n') + ')')} ELSE 0.0e0 END AS score FROM (SELECT DISTINCT doc_id FROM b) d LEFT JOIN s USING (doc_id)""")
def margin_consistency(spark, sf) -> DataFrame:
    return G.margin_scores(A.boxes(spark, sf)).withColumn("score", rounded(F.col("score")))


@query(f"""{B}, g AS (SELECT doc_id, lead(y) OVER (PARTITION BY doc_id ORDER BY y, x, ord) - (y + h) AS g FROM b),
s AS (SELECT doc_id, sum(g) FILTER (WHERE g > 0) AS s, sum(g * g) FILTER (WHERE g > 0) AS q, count(*) FILTER (WHERE g > 0) AS n FROM g GROUP BY 1)
SELECT doc_id, n AS gaps, CASE WHEN n >= 2 THEN {r('100 * exp(-2.4e0 * ' + _cv('s', 'q', 'n') + ')')} END AS score, CASE WHEN n >= 2 THEN {_cv('s', 'q', 'n')} > 0.55e0 END AS weak FROM s""")
def vertical_gap_rhythm(spark, sf) -> DataFrame:
    return G.gap_scores(A.boxes(spark, sf)).withColumn("score", rounded(F.col("score")))


def _snap(values: str, eps: str) -> str:
    return f"""(SELECT doc_id, CASE WHEN count(*) = 1 THEN 1.0e0 ELSE sum(CASE WHEN v - pv <= {eps} OR nv - v <= {eps} THEN 1 ELSE 0 END) / count(*)::DOUBLE END AS ratio
 FROM (SELECT doc_id, v, lag(v) OVER (PARTITION BY doc_id ORDER BY v) AS pv, lead(v) OVER (PARTITION BY doc_id ORDER BY v) AS nv FROM ({values})) GROUP BY 1)"""


@query(f"""{B} SELECT p.doc_id, {r('p.ratio')} AS snap_x, {r('q.ratio')} AS snap_cx, {r('100 * (p.ratio + q.ratio) / 2')} AS score
FROM {_snap('SELECT doc_id, x AS v FROM b', '2')} p JOIN {_snap('SELECT doc_id, x + w / 2 AS v FROM b', '2')} q USING (doc_id)""")
def snap_alignment(spark, sf) -> DataFrame:
    out = G.alignment_scores(A.boxes(spark, sf))
    return out.select("doc_id", *[rounded(F.col(c)).alias(c) for c in out.columns[1:]])


@query(f"""{B} SELECT p.doc_id, {r('p.ratio')} AS snap_x, {r('q.ratio')} AS snap_y, {r('100 * (p.ratio + q.ratio) / 2')} AS score
FROM {_snap('SELECT doc_id, unnest([x, x + w]) AS v FROM b', '6')} p JOIN {_snap('SELECT doc_id, unnest([y, y + h]) AS v FROM b', '6')} q USING (doc_id)""")
def edge_grid(spark, sf) -> DataFrame:
    out = G.edge_grid_scores(A.boxes(spark, sf))
    return out.select("doc_id", *[rounded(F.col(c)).alias(c) for c in out.columns[1:]])


_G = ", ".join(f"avg(CASE WHEN least(v % {g}, {g} - v % {g}) <= 2 THEN 1.0e0 ELSE 0.0e0 END) AS g{g}" for g in (4, 8, 12, 16))


@query(f"""{B}, v AS (SELECT doc_id, unnest([x, y, w, h]) AS v FROM b), s AS (SELECT doc_id, {_G} FROM v GROUP BY 1)
SELECT doc_id, CAST(CASE greatest(g4, g8, g12, g16) WHEN g4 THEN 4 WHEN g8 THEN 8 WHEN g12 THEN 12 ELSE 16 END AS BIGINT) AS grid, {r('greatest(g4, g8, g12, g16)')} AS share, {r('100 * greatest(g4, g8, g12, g16)')} AS score FROM s""")
def grid_snap_best(spark, sf) -> DataFrame:
    out = G.grid_scores(A.boxes(spark, sf))
    return out.select("doc_id", "grid", rounded(F.col("share")).alias("share"), rounded(F.col("score")).alias("score"))


@query(f"""{B}, s AS (SELECT doc_id, count(DISTINCT floor(fs / 2 + 0.5e0)) AS levels, max(fs) / min(fs) AS ratio, count(*) AS n FROM b GROUP BY 1)
SELECT doc_id, levels, {r('ratio')} AS ratio, {r('(' + gauss('levels', 3, 1.4) + ' + ' + gauss('ratio', 1.65, 0.65) + ') / 2')} AS score,
CASE WHEN levels <= 1 AND n >= 3 THEN 'hierarchy_weak' WHEN levels > 5 THEN 'too_fragmented' ELSE 'ok' END AS verdict FROM s""")
def typography_levels(spark, sf) -> DataFrame:
    out = G.typography_scores(A.boxes(spark, sf))
    return out.withColumn("ratio", rounded(F.col("ratio"))).withColumn("score", rounded(F.col("score")))


def _f(x: str, cond: str, name: str) -> str:
    return f"sum({x}) FILTER (WHERE {cond}) AS {name}_s, sum(({x}) * ({x})) FILTER (WHERE {cond}) AS {name}_q, count(*) FILTER (WHERE {cond}) AS {name}_n"


@query(f"""{B}, s AS (SELECT doc_id, {_f('w * h', "kind = 'button'", 'size')}, {_f('sqrt(w * h)', "kind = 'image'", 'icon')}, count(DISTINCT floor(radius / 2 + 0.5e0)) FILTER (WHERE radius > 0) AS buckets,
 count(*) FILTER (WHERE radius > 0) AS radii, {_f('x + y', 'true', 'pad')} FROM b GROUP BY 1)
SELECT doc_id, CASE WHEN size_n >= 2 THEN {r('100 * exp(-2.0e0 * ' + _cv('size_s', 'size_q', 'size_n') + ')', 2)} END AS component_size,
 CASE WHEN icon_n >= 2 THEN {r('100 * exp(-3.5e0 * ' + _cv('icon_s', 'icon_q', 'icon_n') + ')', 2)} END AS icon_size,
 CASE WHEN radii >= 2 THEN {r('100 * exp(-0.5e0 * greatest(0, buckets - 2))', 2)} END AS corner_radius,
 CASE WHEN pad_n >= 4 THEN {r('100 * exp(-2.8e0 * ' + _cv('pad_s', 'pad_q', 'pad_n') + ')', 2)} END AS padding FROM s""")
def consistency_metrics(spark, sf) -> DataFrame:
    out = G.consistency_scores(A.boxes(spark, sf))
    return out.select("doc_id", *[rounded(F.col(c), 2).alias(c) for c in out.columns[1:]])


@query(f"""{B} SELECT doc_id, least, coalesce({r('100 / (1 + exp(-1.0e0 * (least - 3.5e0)))')}, 0.0e0) AS score FROM (SELECT doc_id, min(contrast) FILTER (WHERE kind = 'text') AS least FROM b GROUP BY 1)""")
def contrast_sigmoid(spark, sf) -> DataFrame:
    return G.contrast_scores(A.boxes(spark, sf)).withColumn("score", rounded(F.col("score")))


_VW = "greatest(1.0e0, w * h) * CASE kind WHEN 'text' THEN greatest(0.5e0, least(2.0e0, contrast / 4.5e0)) * greatest(0.6e0, least(2.0e0, fs / 16)) WHEN 'image' THEN 2.0e0 ELSE 1.5e0 END"


@query(f"""{B}, v AS (SELECT *, {_VW} AS vw FROM b), s AS (SELECT doc_id, max(vw) / sum(vw) AS f, sum(vw * (x + w / 2)) / sum(vw) / 160 - 0.5e0 AS dx, sum(vw * (y + h / 2)) / sum(vw) / 160 - 0.5e0 AS dy FROM v GROUP BY 1)
SELECT doc_id, {r('f')} AS focus, {r(gauss('f', 0.45, 0.26), 2)} AS focus_score, {r('sqrt(dx * dx + dy * dy)')} AS offset, {r(gauss('sqrt(dx * dx + dy * dy)', 0, 0.28), 2)} AS balance_score FROM s""".replace("AS offset", 'AS "offset"'))
def visual_focus_balance(spark, sf) -> DataFrame:
    out = G.focus_balance(A.boxes(spark, sf))
    return out.select("doc_id", *[rounded(F.col(c), 2 if c.endswith("score") else 4).alias(c) for c in out.columns[1:]])


@query(f"""{B}, v AS (SELECT doc_id, ord, fs * greatest(1.0e0, w) AS v FROM b WHERE kind = 'text'), k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY v, ord) AS i FROM v),
s AS (SELECT doc_id, greatest(0.0e0, least(1.0e0, 2.0e0 * sum(i * v) / (count(*) * sum(v)) - (count(*) + 1) / count(*)::DOUBLE)) AS g FROM k GROUP BY 1)
SELECT doc_id, {r('g')} AS gini, {r(gauss('g', 0.30, 0.24), 2)} AS score FROM s""")
def gini_hierarchy(spark, sf) -> DataFrame:
    out = G.gini_hierarchy(A.boxes(spark, sf))
    return out.select("doc_id", rounded(F.col("gini")).alias("gini"), rounded(F.col("score"), 2).alias("score"))


@query(f"""{B}, {_UNION}, s AS (SELECT doc_id, sum(w * h) AS total, sum(w * h) FILTER (WHERE kind = 'text') AS t FROM b GROUP BY 1),
v AS (SELECT doc_id, t, coalesce(t, 0.0e0) / total AS share, area / 25600 AS d FROM s JOIN u USING (doc_id))
SELECT doc_id, {r('share')} AS share, CASE WHEN t IS NULL THEN 0.0e0 ELSE {r(gauss('share', 0.55, 0.32), 2)} END AS ratio_score,
CASE WHEN d < 0.35e0 AND share > 0.75e0 THEN {r('100 - 100 * least(1.0e0, 4.5e0 * (0.35e0 - d) * (share - 0.75e0))', 2)} END AS sparse_score FROM v""")
def text_image_ratio(spark, sf) -> DataFrame:
    out = G.text_image_scores(A.boxes(spark, sf))
    return out.select("doc_id", rounded(F.col("share")).alias("share"), rounded(F.col("ratio_score"), 2).alias("ratio_score"), rounded(F.col("sparse_score"), 2).alias("sparse_score"))


@query(f"""{B}, t AS (SELECT doc_id, ord, y, x + w / 2 AS cx, y + h / 2 AS cy FROM b WHERE kind = 'text'),
k AS (SELECT *, lead(cx) OVER o - cx AS dx, lead(cy) OVER o - cy AS dy, lead(y) OVER o + 4 < y AS back FROM t WINDOW o AS (PARTITION BY doc_id ORDER BY ord)),
s AS (SELECT doc_id, count(*) AS blocks, coalesce(sum(sqrt(dx * dx + dy * dy)), 0.0e0) / sqrt(51200.0e0) AS p, count(*) FILTER (WHERE back) AS n FROM k GROUP BY 1)
SELECT doc_id, blocks, {r('p')} AS path, n AS backtracks, CASE WHEN blocks < 3 THEN 85.0e0 ELSE {r('greatest(0.0e0, 100 - least(100.0e0, 18 * p + 12 * n))', 2)} END AS score FROM s""")
def reading_flow(spark, sf) -> DataFrame:
    out = G.reading_flow(A.boxes(spark, sf))
    return out.select("doc_id", "blocks", rounded(F.col("path")).alias("path"), "backtracks", rounded(F.col("score"), 2).alias("score"))


@query()
def merge_text_blocks(spark, sf) -> DataFrame:
    return G.merge_text_blocks(A.boxes(spark, sf))


@query()
def suppress_overlaps(spark, sf) -> DataFrame:
    return G.suppress_overlaps(A.boxes(spark, sf))
