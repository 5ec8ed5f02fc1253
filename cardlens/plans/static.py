"""Queries on static geometry and paint of layered cards, with their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.functions.scalars import rounded
from cardlens.operators import plain as P
from cardlens.operators.containers import container_findings
from cardlens.plans.base import query, r
from cardlens.plans.cards import _col, _lum
from cardlens.sources.cards import ITEMS, layered_documents, tiled_documents

# a line's stack, its picture and its text: sizes, places within the stack, whether they are known
_I = f"""it AS {ITEMS}, i AS (SELECT *, doc_id % 3 AS g, 90 + 4 * line AS sw, 40 + 2 * line AS sh, part % 3 * 2 AS pad, 20 + part % 30 AS mw, 16 + part % 20 AS mh, 30 + supp % 40 AS tw,
 CASE WHEN part % 4 <> 0 THEN 18 END AS th, part % 7 = 0 AS gone, supp % 2 = 1 AS text_first, line % 3 = 0 AND supp % 2 = 0 AS covered, supp % 8 = 5 AS weird,
 CASE supp % 4 WHEN 1 THEN 0.0e0 WHEN 2 THEN 1.0e0 ELSE 0.5e0 END AS a FROM it),
p AS (SELECT *, coalesce(sum(sh + g) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sy, weird OR covered AS lost,
 pad + a * (sw - 2 * pad - mw) AS mx, pad + a * (sh - 2 * pad - mh) AS my, pad + a * (sw - 2 * pad - tw) AS tx, pad + a * (sh - 2 * pad - coalesce(th, 20)) AS ty FROM i)"""


@query(f"""WITH {_I} SELECT doc_id, 'root' AS id, 0.0e0 AS x, 0.0e0 AS y, 160.0e0 AS w, 600.0e0 AS h, false AS estimated FROM (SELECT DISTINCT doc_id FROM p)
UNION ALL SELECT doc_id, 's' || ord, 0.0e0, sy::DOUBLE, sw::DOUBLE, sh::DOUBLE, false FROM p
UNION ALL SELECT doc_id, 'foot', 0.0e0, sum(sh + g)::DOUBLE, 100.0e0, 30.0e0, false FROM p GROUP BY 1
UNION ALL SELECT doc_id, 'm' || ord, CASE WHEN NOT lost AND NOT gone THEN mx END, CASE WHEN NOT lost AND NOT gone THEN sy + my END, CASE WHEN NOT lost AND NOT gone THEN mw::DOUBLE END, CASE WHEN NOT lost AND NOT gone THEN mh::DOUBLE END, false FROM p
UNION ALL SELECT doc_id, 't' || ord, CASE WHEN NOT lost THEN tx END, CASE WHEN NOT lost THEN sy + ty END, CASE WHEN NOT lost THEN tw::DOUBLE END, CASE WHEN NOT lost THEN coalesce(th, 20)::DOUBLE END, NOT lost AND th IS NULL FROM p
UNION ALL SELECT doc_id, 'c' || ord, NULL, NULL, NULL, NULL, false FROM p WHERE covered""")
def static_boxes(spark, sf) -> DataFrame:
    """Boxes of layered cards, with open sizes and places."""
    return P.static_layout(layered_documents(spark, sf))


_O = f"""{_I}, o AS (SELECT *, least(mx + mw, tx + tw) - greatest(mx, tx) AS wide, least(my + mh, ty + th) - greatest(my, ty) AS high, lost OR th IS NULL AS shut FROM p)"""


@query(f"WITH {_O} SELECT doc_id, 's' || ord AS stack, 'm' || ord AS image, 't' || ord AS text, wide, high FROM o WHERE NOT shut AND NOT gone AND wide > 0.5e0 AND high > 0.5e0")
def stack_text_image_overlap(spark, sf) -> DataFrame:
    """Pictures and texts of different branches of a stack that meet."""
    return P.stack_text_image_overlaps(layered_documents(spark, sf))


@query(f"""WITH {_O}, c AS (SELECT doc_id, NOT gone AND NOT covered AS candidate, shut, NOT shut AND NOT gone AND wide > 0.5e0 AND high > 0.5e0 AS hit FROM o)
SELECT doc_id, count(*) FILTER (WHERE candidate) AS candidates, CASE WHEN coalesce(bool_or(hit), false) THEN 'issue' WHEN count(*) FILTER (WHERE candidate) = 0 THEN 'not_applicable'
WHEN bool_or(candidate AND shut) THEN 'undetermined' ELSE 'clear' END AS verdict FROM c GROUP BY 1""")
def stack_overlap_verdicts(spark, sf) -> DataFrame:
    """One of four verdicts a card on pictures over texts."""
    return P.stack_verdicts(layered_documents(spark, sf))


_Y = f"""{_I}, f AS (SELECT doc_id, max(sy + sh + g) AS fy FROM p GROUP BY 1)"""


@query(f"""WITH {_Y}, o AS (SELECT p.doc_id, 't' || ord AS text, 'foot' AS target, least(tx + tw, 100) - greatest(tx, 0) AS wide, fy - (sy + ty + 20) AS gap FROM p JOIN f USING (doc_id) WHERE NOT lost AND th IS NULL)
SELECT doc_id, text, target, CASE WHEN gap < -0.5e0 THEN 'overlap' ELSE 'low_gap' END AS relation, gap::DOUBLE AS gap FROM o WHERE wide > 0.5e0 AND (gap < -0.5e0 OR (gap >= 0 AND gap < 2))""")
def text_surface_overlap(spark, sf) -> DataFrame:
    """Texts whose estimated lines reach the rounded surface below their stack."""
    return P.text_surface_overlaps(layered_documents(spark, sf))


def _mix(c: str, at: int) -> str:
    return f"({_ch01(c, at)} * (128 / 255.0e0) + 1.0e0 * (1 - 128 / 255.0e0))"


def _ch01(c: str, at: int) -> str:
    return f"(CAST('0x' || substr({c}, {at}, 2) AS INTEGER) / 255.0e0)"


def _lin01(x: str) -> str:
    return f"CASE WHEN {x} <= 0.04045e0 THEN {x} / 12.92e0 ELSE pow(({x} + 0.055e0) / 1.055e0, 2.4e0) END"


_VEIL = f"(0.2126e0 * {_lin01(_mix('bg', 2))} + 0.7152e0 * {_lin01(_mix('bg', 4))} + 0.0722e0 * {_lin01(_mix('bg', 6))})"
_RATIO = "(greatest(lf, {b}) + 0.05e0) / (least(lf, {b}) + 0.05e0)"


@query(f"""WITH {_I}, k AS (SELECT *, {_col('supp')} AS fg, {_col('part')} AS bg, {_col('(part + 1)')} AS bg2, {_col('(part + 2)')} AS top, part % 5 AS paint FROM p),
l AS (SELECT *, {_lum('fg')} AS lf, CASE WHEN paint = 0 OR paint = 2 THEN {_lum('bg')} WHEN paint = 1 THEN {_VEIL} WHEN paint = 4 THEN 1.0e0 END AS lb, CASE WHEN paint = 2 THEN {_lum('bg2')} END AS lb2, {_lum('top')} AS lt FROM k),
c AS (SELECT doc_id, ord, CASE WHEN covered THEN {_RATIO.format(b='lt')} WHEN (text_first OR gone) AND lb IS NOT NULL THEN {_RATIO.format(b='lb')} END AS r1, CASE WHEN NOT covered AND (text_first OR gone) AND lb2 IS NOT NULL THEN {_RATIO.format(b='lb2')} END AS r2 FROM l),
m AS (SELECT doc_id, ord, least(r1, r2) AS lo, greatest(r1, r2) AS hi FROM c)
SELECT doc_id, 't' || ord AS id, CASE WHEN lo IS NULL OR (lo < 4.5e0 AND hi >= 4.5e0) THEN 'open' WHEN lo >= 4.5e0 THEN 'clear' WHEN lo < 3 THEN 'error' ELSE 'warning' END AS state, {r('lo', 3)} AS lowest, {r('hi', 3)} AS highest FROM m""")
def contrast_states(spark, sf) -> DataFrame:
    """Contrast of every text against all that may lie behind it: solid, veiled, gradient, covered or open grounds."""
    found = P.text_contrasts(layered_documents(spark, sf))
    return found.select("doc_id", "id", "state", rounded(F.col("lowest"), 3).alias("lowest"), rounded(F.col("highest"), 3).alias("highest"))


@query(f"""WITH it AS {ITEMS}, i AS (SELECT *, CASE part % 9 WHEN 0 THEN 0 WHEN 1 THEN 20 ELSE 8 END AS rg, CASE WHEN supp % 5 = 0 THEN 110 ELSE 50 END AS bw, CASE WHEN part % 3 = 0 THEN 0 ELSE 8 END AS p,
 10 + 2 * line AS f, supp % 6 AS g, 42 + part % 40 AS room, line % 3 AS top, supp % 3 = 0 AS painted FROM it),
e AS (SELECT *, CASE WHEN least(p, 120 - p - bw) < 4 AND (p = 0 OR bw >= 120 - 2 * p) THEN least(p, 120 - p - bw) END AS eb, CASE WHEN p = 0 AND least(bw + rg, 90 - bw - rg) < 4 THEN least(bw + rg, 90 - bw - rg) END AS et,
 room - f - 24 - top - 2 * g AS free, line % 2 = 0 AND f - supp % 4 + 24 + top + 2 * g - room >= 4 AS over FROM i),
s AS (SELECT doc_id, bw, rg, count(*) AS n, min(ord) AS o FROM i GROUP BY 1, 2, 3), k AS (SELECT doc_id, bw, count(*) AS kinds, sum(n) AS total FROM s GROUP BY 1, 2)
SELECT doc_id, 'c' || ord AS id, 'LAYOUT_VERTICAL_DENSITY_HIGH' AS code, free::DOUBLE AS actual, CASE WHEN painted THEN 8.0e0 ELSE -4.0e0 END AS expected FROM e WHERE part % 7 <> 0 AND NOT over AND free < CASE WHEN painted THEN 8 ELSE -4 END
UNION ALL SELECT doc_id, 'l' || ord, CASE WHEN g + top = 0 AND part % 2 = 0 THEN 'TEXT_COLLISION_RISK' ELSE 'TEXT_GAP_LOW' END, (g + top)::DOUBLE, 4.0e0 FROM e WHERE part % 7 <> 0 AND f >= 20 AND supp % 4 > 0 AND g + top < 4
UNION ALL SELECT doc_id, 'r' || ord, 'SURFACE_CONTENT_EDGE_CLEARANCE_LOW', least(eb, et)::DOUBLE, 4.0e0 FROM e WHERE coalesce(eb, et) IS NOT NULL
UNION ALL SELECT o.doc_id, 'r' || o.o, CASE WHEN o.rg = 0 THEN 'LAYOUT_SPACING_MISSING' ELSE 'LAYOUT_SPACING_INCONSISTENT' END, o.rg::DOUBLE, m.rg::DOUBLE FROM k JOIN s o USING (doc_id, bw) JOIN s m ON m.doc_id = k.doc_id AND m.bw = k.bw AND m.rg <> o.rg
WHERE kinds = 2 AND total >= 3 AND o.n = 1 AND m.rg > 0""")
def container_rules(spark, sf) -> DataFrame:
    """Findings on containers and their children of tiled cards: room, large ink, edges and odd gaps."""
    return container_findings(tiled_documents(spark, sf))
