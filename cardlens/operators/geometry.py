"""Operators on the rectangles of a card: pairs, unions, gaps, snapping, and the scores from them.

All take boxes (doc_id, ord, x, y, w, h, kind, ...) and give one row per document unless they
say otherwise. A document is a card, so its boxes are few; pairs are joined within documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlens.functions import scalars as S

CARD = 160.0


def _sums(x: Column, name: str) -> list[Column]:
    return [F.sum(x).alias(f"{name}_sum"), F.sum(x * x).alias(f"{name}_sq"), F.count(x).alias(f"{name}_n")]


def _cv(name: str) -> Column:
    return S.variation(F.col(f"{name}_sum"), F.col(f"{name}_sq"), F.col(f"{name}_n"))


def iou_pairs(boxes: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """doc_id, a, b, a_kind, b_kind, iou of every two boxes that intersect, unless one holds the other."""
    cols = ("ord", "x", "y", "w", "h", "kind")
    a = boxes.select("doc_id", *[F.col(c).alias(f"a_{c}") for c in cols])
    b = boxes.select("doc_id", *[F.col(c).alias(f"b_{c}") for c in cols])
    r = [F.col(f"{s}_{c}") for s in "ab" for c in ("x", "y", "w", "h")]
    pairs = a.join(b, "doc_id").filter(F.col("a_ord") < F.col("b_ord"))
    pairs = pairs.filter(~S.contains(*r, tolerance) & ~S.contains(*r[4:], *r[:4], tolerance)).withColumn("iou", S.iou(*r)).filter("iou > 0")
    return pairs.select("doc_id", F.col("a_ord").alias("a"), F.col("b_ord").alias("b"), "a_kind", "b_kind", "iou")


def overlap_scores(boxes: DataFrame, factor: float = 180.0, warn: float = 0.04, high: float = 0.12, tolerance: float = 1.0) -> DataFrame:
    """max_iou, score = 100 - factor * max_iou, severity, magnitude; null score with under two boxes."""
    worst = iou_pairs(boxes, tolerance).groupBy("doc_id").agg(F.max("iou").alias("m"))
    out = boxes.groupBy("doc_id").agg(F.count("*").alias("n")).join(worst, "doc_id", "left").withColumn("m", F.coalesce("m", F.lit(0.0)))
    score = F.when(F.col("n") >= 2, F.greatest(F.lit(0.0), 100.0 - factor * F.col("m")))
    severity = F.when(F.col("m") >= high, "high").when(F.col("m") >= warn, "medium")
    return out.select("doc_id", F.col("m").alias("max_iou"), score.alias("score"), severity.alias("severity"), F.least(F.lit(1.0), F.col("m") / 0.25).alias("magnitude"))


def layout_overlap_deductions(boxes: DataFrame, warn: float = 0.08, hard: float = 0.2, top: int = 3) -> DataFrame:
    """Deductions for overlaps on the rendered card: severity, delta, magnitude, the worst pairs."""
    pairs = iou_pairs(boxes, 2.0)
    critical = F.col("a_kind").isin("text", "button") | F.col("b_kind").isin("text", "button")
    buttons = (F.col("a_kind") == "button") & (F.col("b_kind") == "button")
    severe = (F.col("iou") >= hard) | ((F.col("iou") >= warn) & buttons)
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("iou"), "a", "b"))
    shown = F.when(rank <= top, F.concat_ws("-", "a_kind", "b_kind"))
    ranked = pairs.withColumn("rank", rank).withColumn("shown", shown)
    out = ranked.groupBy("doc_id").agg(
        F.max("iou").alias("max_iou"),
        F.bool_or(critical & (F.col("iou") >= warn)).alias("important"),
        F.bool_or(severe).alias("severe"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("shown").isNotNull(), F.struct("rank", "shown")))), lambda p: p["shown"]), ", ").alias("pairs"),
    )
    return out.filter((F.col("max_iou") >= warn) | F.col("important")).select(
        "doc_id",
        F.when(F.col("severe"), "high").otherwise("medium").alias("severity"),
        (-F.greatest(F.lit(6.0), F.col("max_iou") * 100.0)).alias("delta"),
        F.least(F.lit(1.0), F.col("max_iou") / 0.25).alias("magnitude"),
        "pairs",
    )


def union_area(boxes: DataFrame, width: float = CARD, height: float = CARD) -> DataFrame:
    """doc_id, area: the area that clipped boxes cover, by coordinate compression.

    The cells between neighbouring left and right edges are made of the document's own edges;
    within a strip the covered height is the sum of what each box adds below the ones before it.
    """
    x1, y1 = F.greatest(F.col("x"), F.lit(0.0)), F.greatest(F.col("y"), F.lit(0.0))
    x2, y2 = F.least(F.col("x") + F.col("w"), F.lit(width)), F.least(F.col("y") + F.col("h"), F.lit(height))
    clipped = boxes.select("doc_id", x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2")).filter("x2 > x1 AND y2 > y1")
    edges = clipped.select("doc_id", F.explode(F.array("x1", "x2")).alias("left")).distinct()
    strips = edges.withColumn("right", F.lead("left").over(Window.partitionBy("doc_id").orderBy("left"))).filter("right IS NOT NULL")
    inside = strips.join(clipped, "doc_id").filter("x1 <= left AND x2 >= right").select("doc_id", "left", "right", "y1", "y2")
    before = F.max("y2").over(Window.partitionBy("doc_id", "left").orderBy("y1", "y2").rowsBetween(Window.unboundedPreceding, -1))
    added = F.greatest(F.lit(0.0), F.col("y2") - F.greatest(F.col("y1"), F.coalesce(before, F.col("y1"))))
    covered = inside.withColumn("added", added).groupBy("doc_id").agg(F.sum(F.col("added") * (F.col("right") - F.col("left"))).alias("area"))
    return boxes.select("doc_id").distinct().join(covered, "doc_id", "left").select("doc_id", F.coalesce("area", F.lit(0.0)).alias("area"))


def density_scores(boxes: DataFrame, width: float = CARD, height: float = CARD) -> DataFrame:
    """density, and the band scores of density and of white space."""
    d = F.col("area") / (width * height)
    return union_area(boxes, width, height).select(
        "doc_id", d.alias("density"), S.band_score(d, 0.28, 0.82, 0.12, 0.18).alias("density_score"), S.band_score(1.0 - d, 0.18, 0.72, 0.12, 0.16).alias("whitespace_score")
    )


def area_scores(boxes: DataFrame, width: float = CARD, height: float = CARD) -> DataFrame:
    """density, and the layout's own bands for density and white space."""
    d = F.col("area") / (width * height)
    return union_area(boxes, width, height).select(
        "doc_id", d.alias("density"), S.band_score(d, 0.35, 0.9, 0.1, 0.2).alias("density_score"), S.band_score(1.0 - d, 0.1, 0.65, 0.18, 0.12).alias("whitespace_score")
    )


def typography_rhythm(boxes: DataFrame) -> DataFrame:
    """(doc_id, levels, score): how many font sizes, to the nearest two, a card's texts have; 0 without texts."""
    level = F.when(F.col("kind") == "text", F.bround(F.col("fs") / 2.0))
    sums = boxes.groupBy("doc_id").agg(F.countDistinct(level).alias("levels"))
    score = F.when(F.col("levels") > 0, S.gaussian_score(F.col("levels").cast("double"), 3.0, 1.6)).otherwise(0.0)
    return sums.select("doc_id", "levels", score.alias("score"))


def overflow_scores(boxes: DataFrame, width: float = CARD, height: float = CARD) -> DataFrame:
    """outside: share of the boxes' area beyond the card; score = 100 - 100 * outside."""
    inside = S.intersection(*[F.col(c) for c in "xywh"], F.lit(0.0), F.lit(0.0), F.lit(width), F.lit(height))
    sums = boxes.groupBy("doc_id").agg(F.sum(F.col("w") * F.col("h")).alias("total"), F.sum(F.col("w") * F.col("h") - inside).alias("out"))
    outside = F.when(F.col("total") > 0, F.col("out") / F.col("total")).otherwise(0.0)
    return sums.select("doc_id", outside.alias("outside"), F.greatest(F.lit(0.0), 100.0 - 100.0 * outside).alias("score"))


def _edges(boxes: DataFrame, width: float, height: float) -> DataFrame:
    distances = {"l": F.col("x"), "t": F.col("y"), "r": width - (F.col("x") + F.col("w")), "b": height - (F.col("y") + F.col("h"))}
    return boxes.select("doc_id", *[d.alias(n) for n, d in distances.items()])


def padding_scores(boxes: DataFrame, width: float = CARD, height: float = CARD, near: float = 8.0) -> DataFrame:
    """Evenness of the least distances to the four edges; too_close: any below ``near``."""
    least = _edges(boxes, width, height).groupBy("doc_id").agg(*[F.min(c).alias(c) for c in "ltrb"])
    v = [F.greatest(F.lit(0.0), F.col(c)) for c in "ltrb"]
    cv = S.variation(v[0] + v[1] + v[2] + v[3], v[0] * v[0] + v[1] * v[1] + v[2] * v[2] + v[3] * v[3], F.lit(4))
    score = 100.0 * F.exp(-2.2 * cv)
    return least.select("doc_id", score.alias("score"), (F.least(*v) < near).alias("too_close"))


def margin_scores(boxes: DataFrame, width: float = CARD, height: float = CARD) -> DataFrame:
    """Evenness of all distances to the edges that aren't negative."""
    stacked = _edges(boxes, width, height).select("doc_id", F.explode(F.array(*[F.col(c) for c in "ltrb"])).alias("v")).filter("v >= 0")
    sums = stacked.groupBy("doc_id").agg(*_sums(F.col("v"), "v"))
    out = boxes.select("doc_id").distinct().join(sums, "doc_id", "left")
    return out.select("doc_id", F.when(F.col("v_n") > 0, 100.0 * F.exp(-2.4 * _cv("v"))).otherwise(0.0).alias("score"))


def gap_scores(boxes: DataFrame, factor: float = 2.4, weak: float = 0.55) -> DataFrame:
    """Evenness of the positive gaps between boxes in the order of y, x; null under two gaps."""
    gap = F.lead("y").over(Window.partitionBy("doc_id").orderBy("y", "x", "ord")) - (F.col("y") + F.col("h"))
    sums = boxes.withColumn("g", gap).groupBy("doc_id").agg(*_sums(F.when(F.col("g") > 0, F.col("g")), "g"))
    enough = F.col("g_n") >= 2
    return sums.select("doc_id", F.col("g_n").alias("gaps"), F.when(enough, 100.0 * F.exp(-factor * _cv("g"))).alias("score"), F.when(enough, _cv("g") > weak).alias("weak"))


def _near(value: str, eps: float, *within: str) -> Column:
    """1 if a neighbour among the sorted values of a document is within ``eps``, else 0."""
    w, v = Window.partitionBy("doc_id", *within).orderBy(value), F.col(value)
    near = F.coalesce(v - F.lag(v).over(w) <= eps, F.lit(False)) | F.coalesce(F.lead(v).over(w) - v <= eps, F.lit(False))
    return near.cast("int")


def _snapped(near: Column) -> Column:
    """The share of values that snap; a single one does. ``near`` is null for values of another kind."""
    return F.when(F.count(near) == 1, 1.0).otherwise(F.sum(near) / F.count(near))


def snap_ratio(values: DataFrame, value: str, eps: float) -> DataFrame:
    """doc_id, ratio: the share of sorted values with a neighbour within ``eps``; a single one snaps."""
    return values.withColumn("near", _near(value, eps)).groupBy("doc_id").agg(_snapped(F.col("near")).alias("ratio"))


def alignment_scores(boxes: DataFrame, eps: float = 2.0) -> DataFrame:
    """100 times the mean of how left edges and centres snap."""
    centred = boxes.select("doc_id", "x", (F.col("x") + F.col("w") / 2.0).alias("cx"))
    near = centred.select("doc_id", _near("x", eps).alias("near_x"), _near("cx", eps).alias("near_cx"))
    out = near.groupBy("doc_id").agg(_snapped(F.col("near_x")).alias("snap_x"), _snapped(F.col("near_cx")).alias("snap_cx"))
    return out.select("doc_id", "snap_x", "snap_cx", (100.0 * (F.col("snap_x") + F.col("snap_cx")) / 2.0).alias("score"))


def edge_grid_scores(boxes: DataFrame, eps: float = 6.0) -> DataFrame:
    """Snapping of (x, right edge) and (y, bottom edge) values."""
    edges = F.array(*[F.struct(F.lit(axis).alias("axis"), v.alias("v")) for axis, size in (("x", "w"), ("y", "h")) for v in (F.col(axis), F.col(axis) + F.col(size))])
    near = boxes.select("doc_id", F.inline(edges)).select("doc_id", "axis", _near("v", eps, "axis").alias("near"))
    out = near.groupBy("doc_id").agg(*[_snapped(F.when(F.col("axis") == axis, F.col("near"))).alias(f"snap_{axis}") for axis in "xy"])
    return out.select("doc_id", "snap_x", "snap_y", (100.0 * (F.col("snap_x") + F.col("snap_y")) / 2.0).alias("score"))


def grid_scores(boxes: DataFrame, grids: tuple[int, ...] = (4, 8, 12, 16), eps: float = 2.0) -> DataFrame:
    """The grid on which most coordinates lie within ``eps``; the first of equals."""
    values = boxes.select("doc_id", F.explode(F.array("x", "y", "w", "h")).alias("v"))

    def off(g: int) -> Column:
        r = F.pmod(F.col("v"), F.lit(float(g)))
        return F.least(r, g - r)

    shares = values.groupBy("doc_id").agg(*[F.avg((off(g) <= eps).cast("double")).alias(f"g{g}") for g in grids])
    best = F.greatest(*[F.col(f"g{g}") for g in grids])
    grid = F.lit(None).cast("int")
    for g in reversed(grids):
        grid = F.when(F.col(f"g{g}") == best, g).otherwise(grid)
    return shares.select("doc_id", grid.cast("long").alias("grid"), best.alias("share"), (100.0 * best).alias("score"))


def typography_scores(boxes: DataFrame) -> DataFrame:
    """Levels of font size (steps of two) and the ratio of the largest to the smallest."""
    level = F.floor(F.col("fs") / 2.0 + 0.5) * 2
    sums = boxes.groupBy("doc_id").agg(F.countDistinct(level).alias("levels"), (F.max("fs") / F.min("fs")).alias("ratio"), F.count("*").alias("n"))
    score = (S.gaussian_score(F.col("levels").cast("double"), 3.0, 1.4) + S.gaussian_score(F.col("ratio"), 1.65, 0.65)) / 2.0
    verdict = F.when((F.col("levels") <= 1) & (F.col("n") >= 3), "hierarchy_weak").when(F.col("levels") > 5, "too_fragmented").otherwise("ok")
    return sums.select("doc_id", "levels", "ratio", score.alias("score"), verdict.alias("verdict"))


def consistency_scores(boxes: DataFrame) -> DataFrame:
    """Component sizes, icon sizes, corner radii and paddings: null where there are too few."""
    area = F.col("w") * F.col("h")
    image = F.when(F.col("kind") == "image", F.sqrt(area))
    radius = F.when(F.col("radius") > 0, F.floor(F.col("radius") / 2.0 + 0.5))
    sums = boxes.groupBy("doc_id").agg(
        *_sums(F.when(F.col("kind") == "button", area), "size"), *_sums(image, "icon"), F.countDistinct(radius).alias("buckets"), F.count(radius).alias("radii"), *_sums(F.col("x") + F.col("y"), "pad")
    )
    return sums.select(
        "doc_id",
        F.when(F.col("size_n") >= 2, 100.0 * F.exp(-2.0 * _cv("size"))).alias("component_size"),
        F.when(F.col("icon_n") >= 2, 100.0 * F.exp(-3.5 * _cv("icon"))).alias("icon_size"),
        F.when(F.col("radii") >= 2, 100.0 * F.exp(-0.5 * F.greatest(F.lit(0), F.col("buckets") - 2))).alias("corner_radius"),
        F.when(F.col("pad_n") >= 4, 100.0 * F.exp(-2.8 * _cv("pad"))).alias("padding"),
    )


def contrast_scores(boxes: DataFrame, target: float = 3.5, k: float = 1.0) -> DataFrame:
    """Sigmoid of the least contrast of the text boxes; 0 without text."""
    least = boxes.groupBy("doc_id").agg(F.min(F.when(F.col("kind") == "text", F.col("contrast"))).alias("least"))
    return least.select("doc_id", "least", F.coalesce(S.sigmoid_score(F.col("least"), target, k), F.lit(0.0)).alias("score"))


def visual_weight() -> Column:
    """Area times a share for text by its contrast and size; images and buttons count double and one and a half."""
    text = S.clamp(F.col("contrast") / 4.5, 0.5, 2.0) * S.clamp(F.col("fs") / 16.0, 0.6, 2.0)
    return F.greatest(F.lit(1.0), F.col("w") * F.col("h")) * F.when(F.col("kind") == "text", text).when(F.col("kind") == "image", 2.0).otherwise(1.5)


def focus_balance(boxes: DataFrame, width: float = CARD, height: float = CARD) -> DataFrame:
    """Share of the heaviest box, and how far the centre of weight is from the card's centre."""
    w = visual_weight()
    sums = boxes.withColumn("vw", w).groupBy("doc_id").agg(
        F.sum("vw").alias("total"), F.max("vw").alias("most"), F.sum(F.col("vw") * (F.col("x") + F.col("w") / 2.0)).alias("mx"), F.sum(F.col("vw") * (F.col("y") + F.col("h") / 2.0)).alias("my")
    )
    share = F.col("most") / F.col("total")
    dx, dy = F.col("mx") / F.col("total") / width - 0.5, F.col("my") / F.col("total") / height - 0.5
    offset = F.sqrt(dx * dx + dy * dy)
    return sums.select("doc_id", share.alias("focus"), S.gaussian_score(share, 0.45, 0.26).alias("focus_score"), offset.alias("offset"), S.gaussian_score(offset, 0.0, 0.28).alias("balance_score"))


def gini_hierarchy(boxes: DataFrame, every: bool = False) -> DataFrame:
    """Gini coefficient of font size times width over the text boxes, and its score. ``every``: cards without text have a row, too, with score 0."""
    if every:
        return _every(boxes, gini_hierarchy(boxes))
    v = boxes.filter("kind = 'text'").select("doc_id", "ord", (F.col("fs") * F.greatest(F.lit(1.0), F.col("w"))).alias("v"))
    ranked = v.withColumn("i", F.row_number().over(Window.partitionBy("doc_id").orderBy("v", "ord")))
    sums = ranked.groupBy("doc_id").agg(F.sum("v").alias("total"), F.sum(F.col("i") * F.col("v")).alias("weighted"), F.count("*").alias("n"))
    g = S.clamp(2.0 * F.col("weighted") / (F.col("n") * F.col("total")) - (F.col("n") + 1) / F.col("n"), 0.0, 1.0)
    return sums.select("doc_id", g.alias("gini"), S.gaussian_score(g, 0.30, 0.24).alias("score"))


def text_image_scores(boxes: DataFrame) -> DataFrame:
    """Text's share of all area: its score, and the penalty for sparse stacks of text (null if none applies)."""
    area = F.col("w") * F.col("h")
    sums = boxes.groupBy("doc_id").agg(F.sum(area).alias("total"), F.sum(F.when(F.col("kind") == "text", area)).alias("text"))
    out = sums.join(union_area(boxes), "doc_id")
    share, density = F.coalesce(F.col("text"), F.lit(0.0)) / F.col("total"), F.col("area") / (CARD * CARD)
    density_gap, text_gap = F.lit(0.35) - density, share - 0.75
    sparse = F.when((density_gap > 0) & (text_gap > 0), 100.0 - 100.0 * S.clamp(4.5 * density_gap * text_gap, 0.0, 1.0))
    return out.select("doc_id", share.alias("share"), F.when(F.col("text").isNull(), 0.0).otherwise(S.gaussian_score(share, 0.55, 0.32)).alias("ratio_score"), sparse.alias("sparse_score"))


def _every(boxes: DataFrame, scores: DataFrame) -> DataFrame:
    """(doc_id, score) of every card of ``boxes``: 0 where ``scores`` have none."""
    return boxes.select("doc_id").distinct().join(scores.select("doc_id", "score"), "doc_id", "left").select("doc_id", F.coalesce("score", F.lit(0.0)).alias("score"))


def reading_flow(boxes: DataFrame, width: float = CARD, height: float = CARD, every: bool = False) -> DataFrame:
    """Path length between text boxes in order, in diagonals, and steps back upwards. ``every``: as in ``gini_hierarchy``."""
    if every:
        return _every(boxes, reading_flow(boxes, width, height))
    w = Window.partitionBy("doc_id").orderBy("ord")
    text = boxes.filter("kind = 'text'").withColumn("cx", F.col("x") + F.col("w") / 2.0).withColumn("cy", F.col("y") + F.col("h") / 2.0)
    dx, dy = F.lead("cx").over(w) - F.col("cx"), F.lead("cy").over(w) - F.col("cy")
    steps = text.withColumn("step", F.sqrt(dx * dx + dy * dy)).withColumn("back", (F.lead("y").over(w) + 4.0 < F.col("y")).cast("long"))
    sums = steps.groupBy("doc_id").agg(F.count("*").alias("blocks"), F.coalesce(F.sum("step"), F.lit(0.0)).alias("path"), F.coalesce(F.sum("back"), F.lit(0)).alias("backtracks"))
    path = F.col("path") / F.lit((width * width + height * height) ** 0.5)
    score = F.when(F.col("blocks") < 3, 85.0).otherwise(F.greatest(F.lit(0.0), 100.0 - F.least(F.lit(100.0), 18.0 * path + 12.0 * F.col("backtracks"))))
    return sums.select("doc_id", "blocks", path.alias("path"), "backtracks", score.alias("score"))


def merge_text_blocks(boxes: DataFrame, overlap: float = 0.7, gap: float = 8.0) -> DataFrame:
    """doc_id, n: text blocks joined to lines; x, y, w, h of each. A block joins the line before it
    if they overlap vertically and at most ``gap`` lies between: a fold, as lines grow."""
    item = F.struct("y", "x", "w", "h")
    sorted_boxes = boxes.filter("kind = 'text'").groupBy("doc_id").agg(F.array_sort(F.collect_list(item)).alias("b"))

    def step(acc: Column, b: Column) -> Column:
        last = F.element_at(acc, -1)
        shared = F.least(last["y"] + last["h"], b["y"] + b["h"]) - F.greatest(last["y"], b["y"])
        space = b["x"] - (last["x"] + last["w"])
        joins = (shared / F.least(last["h"], b["h"]) > overlap) & space.between(0.0, gap)
        top, left = F.least(last["y"], b["y"]), F.least(last["x"], b["x"])
        wide = F.struct(
            top.alias("y"), left.alias("x"), (F.greatest(last["x"] + last["w"], b["x"] + b["w"]) - left).alias("w"), (F.greatest(last["y"] + last["h"], b["y"] + b["h"]) - top).alias("h")
        )
        return F.when(F.size(acc) == 0, F.array(b)).when(joins, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(wide))).otherwise(F.concat(acc, F.array(b)))

    none = F.array().cast("array<struct<y:double,x:double,w:double,h:double>>")
    lines = sorted_boxes.select("doc_id", F.posexplode(F.aggregate("b", none, step)).alias("n", "l"))
    return lines.select("doc_id", F.col("n").cast("long").alias("n"), "l.x", "l.y", "l.w", "l.h")


def suppress_overlaps(boxes: DataFrame, most: float = 0.55) -> DataFrame:
    """Greedy suppression: boxes by area, a box stays unless it overlaps a larger one that stays."""
    item = F.struct((-F.col("w") * F.col("h")).alias("k"), "ord", "x", "y", "w", "h")
    ordered = boxes.groupBy("doc_id").agg(F.array_sort(F.collect_list(item)).alias("b"))

    def step(acc: Column, b: Column) -> Column:
        hit = F.exists(acc, lambda a: S.iou(*[a[c] for c in "xywh"], *[b[c] for c in "xywh"]) > most)
        return F.when(hit, acc).otherwise(F.concat(acc, F.array(b)))

    none = F.array().cast("array<struct<k:double,ord:bigint,x:double,y:double,w:double,h:double>>")
    return ordered.select("doc_id", F.explode(F.aggregate("b", none, step)).alias("k")).select("doc_id", "k.ord", "k.x", "k.y", "k.w", "k.h")
