"""Queries on trees, colours and ordered readings, with their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.functions import scalars as S
from cardlens.operators import series as R
from cardlens.operators import tree as T
from cardlens.plans.base import query, r
from cardlens.sources import adapters as A

CLOSURE = f"""WITH RECURSIVE t AS {A.TREE}, c(node, ancestor, distance) AS (SELECT node, node, 0 FROM t
UNION ALL SELECT c.node, t.parent, c.distance + 1 FROM c JOIN t ON t.node = c.ancestor WHERE t.parent IS NOT NULL)"""


@query(f"{CLOSURE} SELECT node, ancestor, CAST(distance AS BIGINT) AS distance FROM c")
def tree_closure(spark, sf) -> DataFrame:
    return T.closure(A.tree(spark, sf)).withColumn("distance", F.col("distance").cast("long"))


@query(f"{CLOSURE} SELECT c.node, NOT bool_or(hidden) AS visible FROM c JOIN t ON t.node = c.ancestor GROUP BY 1")
def tree_visibility(spark, sf) -> DataFrame:
    return T.inherited(A.tree(spark, sf), "hidden").select("node", (~F.col("hidden")).alias("visible"))


@query(f"{CLOSURE} SELECT c.node, bool_or(action) AS action FROM c JOIN t ON t.node = c.ancestor GROUP BY 1")
def action_inheritance(spark, sf) -> DataFrame:
    return T.inherited(A.tree(spark, sf), "action")


@query(f"{CLOSURE} SELECT ancestor AS node, bool_or(action) AS has_action FROM c JOIN t ON t.node = c.node GROUP BY 1")
def descendant_action(spark, sf) -> DataFrame:
    tree = A.tree(spark, sf)
    marked = tree.select("node", "action")
    return T.closure(tree).join(marked, "node").groupBy(F.col("ancestor").alias("node")).agg(F.bool_or("action").alias("has_action"))


@query(f"""WITH RECURSIVE t0 AS {A.TREE}, t AS (SELECT node, CASE WHEN kind = 'Text' AND pos % 10 = 4 THEN 'nowhere' ELSE parent END AS parent FROM t0),
c(node, ancestor) AS (SELECT node, node FROM t UNION ALL SELECT c.node, t.parent FROM c JOIN t ON t.node = c.ancestor WHERE t.parent IS NOT NULL)
SELECT node, 'missing parent' AS reason FROM t WHERE parent IS NOT NULL AND parent NOT IN (SELECT node FROM t)
UNION ALL SELECT node, 'unreachable' FROM t WHERE node NOT IN (SELECT node FROM c WHERE ancestor IN (SELECT node FROM t WHERE parent IS NULL))""")
def tree_validity(spark, sf) -> DataFrame:
    tree = A.tree(spark, sf)
    broken = tree.withColumn("parent", F.when((F.col("kind") == "Text") & (F.col("pos") % 10 == 4), "nowhere").otherwise(F.col("parent")))
    return T.validity(broken)


@query(f"""{CLOSURE} SELECT c.node, CAST(max(distance) AS BIGINT) AS depth, string_agg(lpad(CAST(pos AS VARCHAR), 8, '0'), '/' ORDER BY distance DESC) AS path FROM c JOIN t ON t.node = c.ancestor GROUP BY 1""")
def tree_preorder(spark, sf) -> DataFrame:
    return T.depth_first(A.tree(spark, sf)).withColumn("depth", F.col("depth").cast("long"))


@query(f"""WITH t AS {A.TREE} SELECT node, coalesce(CAST(sum(size + 8) OVER (PARTITION BY parent ORDER BY pos, node ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS "offset" FROM t WHERE kind IN ('Text', 'Image')""")
def linear_layout_cursor(spark, sf) -> DataFrame:
    leaves = A.tree(spark, sf).filter("kind IN ('Text', 'Image')")
    return T.linear_offsets(leaves, ["parent"], F.col("size"), F.lit(8)).select("node", F.col("offset").cast("long").alias("offset"))


@query(f"{CLOSURE} SELECT c.node, CAST(sum(CASE WHEN action THEN 1 ELSE 0 END) AS BIGINT) AS nested FROM c JOIN t ON t.node = c.ancestor GROUP BY 1")
def surface_nesting(spark, sf) -> DataFrame:
    return T.surface_depth(A.tree(spark, sf), "action")


def _ch(c: str, at: int) -> str:
    return f"(CAST('0x' || substr({c}, {at}, 2) AS INTEGER) / 255.0e0)"


def _lin(x: str) -> str:
    return f"(CASE WHEN {x} <= 0.04045e0 THEN {x} / 12.92e0 ELSE pow(({x} + 0.055e0) / 1.055e0, 2.4e0) END)"


PARSED = f"""k AS {A.COLORS}, f AS (SELECT doc_id, ord, color, CASE WHEN length(color) = 9 THEN substr(color, 4, 6) ELSE substr(color, 2, 6) END AS s, CASE WHEN length(color) = 9 THEN {_ch('color', 2)} ELSE 1.0e0 END AS a FROM k),
p AS (SELECT doc_id, ord, color, {_ch('s', 1)} AS r, {_ch('s', 3)} AS g, {_ch('s', 5)} AS b, a FROM f)"""


@query(f"""WITH {PARSED}, w AS (SELECT ord, color, r * a + (1 - a) AS r, g * a + (1 - a) AS g, b * a + (1 - a) AS b FROM p)
SELECT ord, color, {r(f"1.05e0 / (0.2126e0 * {_lin('r')} + 0.7152e0 * {_lin('g')} + 0.0722e0 * {_lin('b')} + 0.05e0)", 3)} AS ratio FROM w""")
def color_parse_contrast(spark, sf) -> DataFrame:
    """Contrast of each colour, laid over white, with white."""
    white = F.struct(*[F.lit(1.0).alias(c) for c in "rgba"])
    over = S.composite(S.parse_color(F.col("color")), white)
    return A.colors(spark, sf).select("ord", "color", S.rounded(S.contrast_ratio(white, over), 3).alias("ratio"))


@query(f"""WITH {PARSED}, h AS (SELECT doc_id, greatest(r, g, b) AS hi, greatest(r, g, b) - least(r, g, b) AS d, r, g, b, a FROM p),
u AS (SELECT doc_id, 60 * CASE WHEN hi = r THEN CASE WHEN g >= b THEN (g - b) / d ELSE (g - b) / d + 6 END WHEN hi = g THEN (b - r) / d + 2 ELSE (r - g) / d + 4 END AS hue FROM h WHERE a >= 0.2e0 AND d >= 0.12e0),
w AS (SELECT doc_id, hue, coalesce(lead(hue) OVER (PARTITION BY doc_id ORDER BY hue), min(hue) OVER (PARTITION BY doc_id) + 360) - hue AS gap FROM u)
SELECT doc_id, count(DISTINCT floor(hue / 30)) AS families, {r('360 - max(gap)', 3)} AS span, count(*) AS colors FROM w GROUP BY 1""")
def hue_families_span(spark, sf) -> DataFrame:
    hues = A.colors(spark, sf).select("doc_id", S.hue_degrees(S.parse_color(F.col("color"))).alias("hue")).filter("hue IS NOT NULL")
    return R.hue_span(hues).withColumn("span", S.rounded(F.col("span"), 3))


@query(f"""WITH {PARSED}, q AS (SELECT doc_id, ord, r, g, b FROM p)
SELECT x.doc_id, count(*) AS pairs, {r('avg(sqrt((x.r - y.r) * (x.r - y.r) + (x.g - y.g) * (x.g - y.g) + (x.b - y.b) * (x.b - y.b)))')} AS distance FROM q x JOIN q y ON x.doc_id = y.doc_id AND x.ord < y.ord GROUP BY 1""")
def avg_color_distance(spark, sf) -> DataFrame:
    """Mean distance of every two colours of a palette."""
    c = A.colors(spark, sf).select("doc_id", "ord", S.parse_color(F.col("color")).alias("c"))
    pairs = c.alias("x").join(c.alias("y"), (F.col("x.doc_id") == F.col("y.doc_id")) & (F.col("x.ord") < F.col("y.ord")))
    d = [F.col(f"x.c.{k}") - F.col(f"y.c.{k}") for k in "rgb"]
    dist = F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2])
    return pairs.groupBy(F.col("x.doc_id").alias("doc_id")).agg(F.count("*").alias("pairs"), S.rounded(F.avg(dist)).alias("distance"))


@query(f"""WITH s AS {A.SERIES}, d AS (SELECT DISTINCT doc_id, v FROM s), n AS (SELECT *, CASE WHEN v - lag(v) OVER (PARTITION BY doc_id ORDER BY v) <= 3 THEN 0 ELSE 1 END AS nw FROM d),
b AS (SELECT *, sum(nw) OVER (PARTITION BY doc_id ORDER BY v) AS block FROM n) SELECT doc_id, CAST(block AS BIGINT) AS block, min(v) AS first, max(v) AS last, count(*) AS n FROM b GROUP BY 1, 2""")
def islands_blocks(spark, sf) -> DataFrame:
    return R.islands(A.series(spark, sf).select("doc_id", "v").distinct(), "v", 3)


@query(f"""WITH s AS (SELECT *, v // 25 AS q FROM {A.SERIES}), n AS (SELECT *, CASE WHEN q = lag(q) OVER (PARTITION BY doc_id ORDER BY ord) THEN 0 ELSE 1 END AS nw FROM s),
b AS (SELECT *, sum(nw) OVER (PARTITION BY doc_id ORDER BY ord) AS k FROM n) SELECT doc_id, min(ord) AS first, count(*) AS n FROM b GROUP BY doc_id, k HAVING count(*) > 4""")
def stability_islands(spark, sf) -> DataFrame:
    rows = A.series(spark, sf).withColumn("q", F.floor(F.col("v") / 25))
    return R.stable_runs(rows, "q", ["ord"])


@query(f"""WITH s AS {A.SERIES}, t AS (SELECT doc_id, sum(v)::DOUBLE AS s, sum(v * v)::DOUBLE AS q, count(*) AS n FROM s GROUP BY 1)
SELECT doc_id, n, {r('CASE WHEN n < 2 OR abs(s / n) < 1e-9 THEN 0.0e0 ELSE abs(sqrt(greatest(q / n - (s / n) * (s / n), 0.0e0)) / (s / n)) END')} AS cv FROM t""")
def series_variation(spark, sf) -> DataFrame:
    return R.series_variation(A.series(spark, sf), "v").withColumn("cv", S.rounded(F.col("cv")))
