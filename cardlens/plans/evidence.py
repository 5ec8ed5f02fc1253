"""Queries on texts and colours as evidence, and on the layout's own bands, with their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.functions.scalars import rounded
from cardlens.operators import evidence as E
from cardlens.operators import geometry as G
from cardlens.plans.base import band, gauss, query, r
from cardlens.plans.geometry import _UNION, B, _cv, _snap
from cardlens.plans.trees import PARSED, _lin
from cardlens.sources import adapters as A


@query(f"""{B}, {_UNION} SELECT doc_id, {r('area / 25600')} AS density, {r(band('area / 25600', 0.35, 0.9, 0.1, 0.2))} AS density_score, {r(band('(1 - area / 25600)', 0.1, 0.65, 0.18, 0.12))} AS whitespace_score FROM u""")
def layout_area(spark, sf) -> DataFrame:
    out = G.area_scores(A.boxes(spark, sf))
    return out.select("doc_id", *[rounded(F.col(c)).alias(c) for c in out.columns[1:]])


@query(f"""{B}, g AS (SELECT doc_id, lead(y) OVER (PARTITION BY doc_id ORDER BY y, x, ord) - (y + h) AS g FROM b),
s AS (SELECT doc_id, sum(g) FILTER (WHERE g > 0) AS s, sum(g * g) FILTER (WHERE g > 0) AS q, count(*) FILTER (WHERE g > 0) AS n FROM g GROUP BY 1)
SELECT doc_id, CASE WHEN n >= 2 THEN {r('100 * exp(-2.2e0 * ' + _cv('s', 'q', 'n') + ')')} END AS score FROM s""")
def layout_spacing(spark, sf) -> DataFrame:
    return G.gap_scores(A.boxes(spark, sf), factor=2.2).select("doc_id", rounded(F.col("score")).alias("score"))


@query(f"""{B} SELECT p.doc_id, {r('100 * (p.ratio + q.ratio) / 2')} AS score
FROM {_snap('SELECT doc_id, x AS v FROM b', '6')} p JOIN {_snap('SELECT doc_id, x + w / 2 AS v FROM b', '6')} q USING (doc_id)""")
def consistency_alignment(spark, sf) -> DataFrame:
    return G.alignment_scores(A.boxes(spark, sf), eps=6.0).select("doc_id", rounded(F.col("score")).alias("score"))


@query(f"""{B}, s AS (SELECT doc_id, count(DISTINCT CASE WHEN kind = 'text' THEN round_even(fs / 2, 0) END) AS levels FROM b GROUP BY 1)
SELECT doc_id, levels, CASE WHEN levels > 0 THEN {r(gauss('levels', 3, 1.6))} ELSE 0.0e0 END AS score FROM s""")
def typography_rhythm(spark, sf) -> DataFrame:
    return G.typography_rhythm(A.boxes(spark, sf)).withColumn("score", rounded(F.col("score")))


def _f(t: str) -> str:
    return f"(CASE WHEN {t} > 0.008856e0 THEN pow({t}, 1.0e0 / 3.0e0) ELSE 7.787e0 * {t} + 16.0e0 / 116.0e0 END)"


_LAB = f"""{PARSED}, l AS (SELECT doc_id, {_lin('r')} AS r, {_lin('g')} AS g, {_lin('b')} AS b FROM p),
x AS (SELECT doc_id, (0.412453e0 * r + 0.357580e0 * g + 0.180423e0 * b) / 0.950456e0 AS x, 0.212671e0 * r + 0.715160e0 * g + 0.072169e0 * b AS y, (0.019334e0 * r + 0.119193e0 * g + 0.950227e0 * b) / 1.088754e0 AS z FROM l),
lab AS (SELECT doc_id, row_number() OVER () AS i, floor(CASE WHEN y > 0.008856e0 THEN 116.0e0 * pow(y, 1.0e0 / 3.0e0) - 16.0e0 ELSE 903.3e0 * y END * 255.0e0 / 100.0e0 + 0.5e0) AS l,
 floor(500.0e0 * ({_f('x')} - {_f('y')}) + 128.5e0) AS a, floor(200.0e0 * ({_f('y')} - {_f('z')}) + 128.5e0) AS b FROM x),
d AS (SELECT u.doc_id, avg(sqrt((u.l - v.l) * (u.l - v.l) + (u.a - v.a) * (u.a - v.a) + (u.b - v.b) * (u.b - v.b))) AS d FROM lab u JOIN lab v ON u.doc_id = v.doc_id AND u.i < v.i GROUP BY 1),
n AS (SELECT doc_id, count(*) AS n FROM lab GROUP BY 1)"""


@query(f"""WITH {_LAB} SELECT doc_id, n AS colors, {r('coalesce(d, 0.0e0)', 3)} AS distance, {r('(' + gauss('n', 4.5, 1.8) + ' + ' + gauss('coalesce(d, 0.0e0)', 65, 35) + ') / 2', 3)} AS harmony, {r(gauss('n', 4, 2), 3)} AS simplicity
FROM n LEFT JOIN d USING (doc_id)""")
def palette_scores(spark, sf) -> DataFrame:
    out = E.palette_scores(A.colors(spark, sf).select("doc_id", "color"))
    return out.select("doc_id", "colors", *[rounded(F.col(c), 3).alias(c) for c in ("distance", "harmony", "simplicity")])


def _turns(spark, sf) -> tuple[DataFrame, DataFrame]:
    """What users ask for, and what assistants show, by conversation."""
    turns = A.table(spark, sf, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("ord"), F.col("turn").alias("id"), "role", "text", (1.0 - F.col("turn") % 8 / 8.0).alias("confidence"))
    return turns.filter("role = 'user'").select("doc_id", "id", "text"), turns.filter("role = 'assistant'").select("doc_id", "ord", "text", "confidence")


@query()
def information_metrics(spark, sf) -> DataFrame:
    """Coverage, truncation and duplicates of every conversation's texts."""
    required, seen = _turns(spark, sf)
    out = None
    for name, f in (("coverage", E.coverage_scores), ("truncation", E.truncation_scores), ("duplicate", E.duplicate_scores)):
        rows = f(required, seen).select("doc_id", F.lit(name).alias("name"), rounded(F.col("score"), 2).alias("score"))
        out = rows if out is None else out.unionByName(rows)
    return out
