"""Spatial joins between the boxes of a card: containment, exclusion, touching surfaces, candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.functions import scalars as S


def _sides(boxes: DataFrame, side: str) -> DataFrame:
    return boxes.select("doc_id", *[F.col(c).alias(f"{side}_{c}") for c in ("ord", "x", "y", "w", "h", "kind")])


def _rect(side: str) -> list[Column]:
    return [F.col(f"{side}_{c}") for c in ("x", "y", "w", "h")]


def texts_inside(boxes: DataFrame) -> DataFrame:
    """doc_id, ord, texts: how many text boxes have their centre inside each other box."""
    outer = _sides(boxes.filter("kind != 'text'"), "o")
    inner = _sides(boxes.filter("kind = 'text'"), "t")
    cx, cy = F.col("t_x") + F.col("t_w") / 2.0, F.col("t_y") + F.col("t_h") / 2.0
    inside = cx.between(F.col("o_x"), F.col("o_x") + F.col("o_w")) & cy.between(F.col("o_y"), F.col("o_y") + F.col("o_h"))
    found = outer.join(inner, "doc_id").filter(inside).groupBy("doc_id", "o_ord").agg(F.count("*").alias("n"))
    return outer.join(found, ["doc_id", "o_ord"], "left").select("doc_id", F.col("o_ord").alias("ord"), F.coalesce("n", F.lit(0)).alias("texts"))


def without_text_doubles(boxes: DataFrame, most: float = 0.8) -> DataFrame:
    """doc_id, ord of the boxes that aren't text and don't nearly coincide with a text box."""
    outer, inner = _sides(boxes.filter("kind != 'text'"), "o"), _sides(boxes.filter("kind = 'text'"), "t").withColumnRenamed("doc_id", "t_doc")
    same = (F.col("doc_id") == F.col("t_doc")) & (S.iou(*_rect("o"), *_rect("t")) > most)
    return outer.join(inner, same, "left_anti").select("doc_id", F.col("o_ord").alias("ord"))


def touching_pairs(boxes: DataFrame, gap: float = 0.5) -> DataFrame:
    """doc_id, a, b, gap: rounded surfaces side by side with at most ``gap`` between them."""
    rounded = boxes.filter("radius > 0")
    a, b = _sides(rounded, "a"), _sides(rounded, "b")
    pairs = a.join(b, "doc_id").filter(F.col("a_ord") < F.col("b_ord"))

    def apart(at: str, size: str) -> Column:
        return F.greatest(F.col(f"b_{at}") - F.col(f"a_{at}") - F.col(f"a_{size}"), F.col(f"a_{at}") - F.col(f"b_{at}") - F.col(f"b_{size}"))

    dx, dy = apart("x", "w"), apart("y", "h")
    found = F.when((dx >= 0) & (dy < 0), dx).when((dy >= 0) & (dx < 0), dy)
    return pairs.withColumn("gap", found).filter(F.col("gap") <= gap).select("doc_id", F.col("a_ord").alias("a"), F.col("b_ord").alias("b"), "gap")


def best_control(boxes: DataFrame) -> DataFrame:
    """doc_id, ord, score: the likeliest control of a card, by score, then lowest, then leftmost."""
    score = F.when(F.col("kind") == "button", 100.0).when(F.col("kind") == "image", 40.0).otherwise(0.0) + F.least(F.col("w"), F.col("h"))
    best = boxes.withColumn("score", score).groupBy("doc_id").agg(F.max(F.struct("score", "y", (-F.col("x")).alias("left"), (-F.col("ord")).alias("o"))).alias("m"))
    return best.select("doc_id", (-F.col("m.o")).alias("ord"), F.col("m.score").alias("score"))


def parse_bounds(x: Column) -> Column:
    """``[l,t][r,b]`` to struct(l, t, r, b); null for anything else, empty areas included."""
    n = F.transform(F.regexp_extract_all(x, F.lit("(-?[0-9]+)"), F.lit(1)), lambda v: v.cast("long"))
    valid = (F.size(n) >= 4) & (F.get(n, F.lit(2)) > F.get(n, F.lit(0))) & (F.get(n, F.lit(3)) > F.get(n, F.lit(1)))
    return F.when(valid, F.struct(*[F.get(n, F.lit(i)).alias(c) for i, c in enumerate("ltrb")]))
