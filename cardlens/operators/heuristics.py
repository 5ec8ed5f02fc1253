"""Heuristic findings on whole cards: colours, layers and hierarchy.

Every rule reads one table of visible components that knows what lies above each of them. That
is found by doubling (tree.walked), so cards of any depth need few rounds. A card gives at most one
finding of each code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.functions import scalars as S
from cardlens.operators import cards as C
from cardlens.operators.rounds import saved
from cardlens.operators.tree import walked

# Most gradients, their most stops, most translucent and most nested surfaces; weights by name.
MOST_GRADIENTS, MOST_STOPS, MOST_TRANSLUCENT, MOST_NESTED = 1, 3, 2, 2
# The longer and the shorter side up to which a card is compact, the content it may hold, the least side of a picture that counts as content.
COMPACT_LONG, COMPACT_SHORT, MOST_CONTENT, PICTURE = 320.0, 180.0, 10, 8.0
WEIGHTS = {"lighter": 100.0, "normal": 400.0, "regular": 400.0, "medium": 500.0, "bold": 700.0, "bolder": 900.0}


def _colors(gradient: Column) -> Column:
    """The colours of a linearGradient's stops; null if it has no list of them."""
    stops = F.from_json(F.get_json_object(gradient, "$.colors"), "array<string>")
    return F.transform(stops, lambda x: F.when(x.startswith("["), F.get_json_object(x, "$[0]")).otherwise(x))


def _translucent(color: Column) -> Column:
    a = S.parse_color(color)["a"]
    return F.coalesce((a > 0) & (a < 0.999), F.lit(False))


def visible_components(docs: DataFrame, units: bool = False) -> DataFrame:
    """(doc_id, id, kind, placed, action, acts, family, stops, nested, layers, prominence, pill) of what isn't hidden, and ``unit`` if asked for.

    ``placed``: it is somebody's child. ``acts``: it or an ancestor has an action. ``family``: of 12 hues,
    that of a chromatic background. ``stops``: of its gradient. ``nested``, ``layers``: the surfaces and the
    translucent ones from it up to the root. ``prominence``: of its text. Components on or below a cycle are left out.
    ``pill``: a text with a rounded ground and a fixed size. ``unit``: a text, a button with words or a picture of some size, in a
    compact card: one whose top (the first that is nobody's child) or a child of it has a compact size.
    """
    get = lambda k: F.try_element_at("styles", F.lit(k))
    comps = C.with_texts(C.components(C.messages(docs)))
    background, gradient = get("backgroundColor"), _colors(get("linearGradient"))
    weight = F.coalesce(C.number(get("fontWeight")), F.try_element_at(F.create_map(*[F.lit(x) for kv in WEIGHTS.items() for x in kv]), get("fontWeight")), F.when(F.col("kind") == "Button", 500.0).otherwise(400.0))
    size = F.when(get("fontSize").isNull(), 16.0).otherwise(C.style("fontSize"))
    shows = F.col("kind").isin("Text", "Button") & (F.size("texts") > 0)
    w, h = C.number(get("width")), C.number(get("height"))
    pill = (F.col("kind") == "Text") & shows & (background.isNotNull() | get("linearGradient").isNotNull()) & (C.number(get("borderRadius")) > 0) & w.isNotNull() & h.isNotNull()
    compact = F.when((F.least(w, h) <= COMPACT_SHORT) & (F.greatest(w, h) <= COMPACT_LONG) & w.isNotNull() & h.isNotNull(), True)
    flat = saved(comps.select(
        "doc_id", "id", "kind", "children", "action", (F.floor(S.hue_degrees(S.parse_color(background)) / 30) % 12).cast("int").alias("family"),
        F.size(gradient).alias("stops"), (background.isNotNull() | get("linearGradient").isNotNull()).alias("surface"),
        (_translucent(background) | F.coalesce(F.exists(gradient, _translucent), F.lit(False))).alias("clear"),
        F.when(shows, size * (1.0 + F.greatest(weight - 400.0, F.lit(0.0)) / 1000.0)).alias("prominence"),
        F.coalesce(get("visibility").isin("hidden", "none"), F.lit(False)).alias("hidden"),
        F.coalesce(pill, F.lit(False)).alias("pill"), (shows | F.coalesce((F.col("kind") == "Image") & (w >= PICTURE) & (h >= PICTURE), F.lit(False))).alias("content"), compact.alias("compact"), "ord",
    ))
    parents = C.edges(flat).groupBy("doc_id", "id").agg(F.min("parent").alias("parent"), F.lit(True).alias("placed"))
    flat = saved(flat.join(parents, ["doc_id", "id"], "left").withColumn("placed", F.coalesce("placed", F.lit(False))))
    tree = flat.withColumnRenamed("id", "node")
    one = lambda c: c.cast("int")
    up = walked(
        tree,
        {
            "_hidden": (F.col("hidden"), lambda a, b: a | b),
            "acts": (F.col("action"), lambda a, b: a | b),
            "nested": (one(F.col("surface") & F.col("placed")), lambda a, b: a + b),
            "layers": (one(F.col("clear")), lambda a, b: a + b),
        },
        ["doc_id"],
    ).filter("ended AND NOT _hidden")
    up = up.dropDuplicates(["doc_id", "node"]).select("doc_id", F.col("node").alias("id"), "acts", "nested", "layers")
    rows = flat.join(up, ["doc_id", "id"])
    kept = ["doc_id", "id", "kind", "placed", "action", "acts", "family", "stops", "nested", "layers", "prominence", "pill"]
    if not units:
        return rows.select(*kept)
    tops = flat.filter("NOT placed AND id IS NOT NULL").groupBy("doc_id").agg(F.min_by(F.struct("id", "compact", "children"), "ord").alias("top"))
    inner = tops.select("doc_id", F.explode("top.children").alias("id")).join(flat.select("doc_id", "id", "compact"), ["doc_id", "id"]).groupBy("doc_id").agg(F.bool_or("compact").alias("inner"))
    small = tops.join(inner, "doc_id", "left").select("doc_id", F.col("top.id").alias("top"), F.coalesce("top.compact", "inner", F.lit(False)).alias("small"))
    rows = rows.join(small, "doc_id", "left")
    unit = F.coalesce(F.col("content") & F.col("small") & (F.col("id") != F.col("top")), F.lit(False))
    return rows.select(*kept, unit.alias("unit"))


def crowding(docs: DataFrame) -> DataFrame:
    """(doc_id, code, actual, expected): AFFORDANCE_FALSE_POSITIVE for texts that look like buttons and do nothing,
    neither they nor what they are in; LAYOUT_DENSITY_HIGH for compact cards of more than ten units. ``actual``: how many."""
    sums = visible_components(docs, units=True).groupBy("doc_id").agg(F.count_if(F.col("pill") & ~F.col("acts")).alias("pills"), F.count_if("unit").alias("units"))
    rules = [("AFFORDANCE_FALSE_POSITIVE", F.col("pills"), 0), ("LAYOUT_DENSITY_HIGH", F.col("units"), MOST_CONTENT)]
    found = F.array(*[F.when(n > most, F.struct(F.lit(code).alias("code"), n.cast("double").alias("actual"), F.lit(float(most)).alias("expected"))) for code, n, most in rules])
    return sums.select("doc_id", F.inline(F.filter(found, lambda x: x.isNotNull())))


def heuristics(docs: DataFrame) -> DataFrame:
    """(doc_id, code, actual, expected): findings on colours, layers and hierarchy, all warnings.

    One pass over the visible components: every rule is a condition on sums by document.
    """
    rows = visible_components(docs)
    chromatic, action = F.col("family").isNotNull(), F.col("action")
    acting = F.col("acts") | (F.col("kind") == "Button")
    sums = rows.groupBy("doc_id").agg(
        F.count_if(F.col("stops") >= 0).alias("gradients"), F.max(F.greatest("stops", F.lit(0))).alias("stops"), F.max("nested").alias("nested"), F.max("layers").alias("layers"),
        F.count_if(chromatic & F.col("placed")).alias("accents"), F.count_if(chromatic & action).alias("colored"), F.size(F.collect_set(F.when(action, F.col("family")))).alias("roles"),
        F.sort_array(F.collect_list("prominence")).alias("p"), F.max(F.when(acting, F.col("prominence"))).alias("p_action"), F.max(F.when(~acting, F.col("prominence"))).alias("p_content"),
    )
    n, top = F.size("p"), F.try_element_at("p", F.lit(-1))
    middle = F.get("p", F.floor(n / 2).cast("int"))
    near = F.size(F.filter("p", lambda v: v >= top * 0.9))
    sums = sums.select("*", n.alias("n"), top.alias("top"), middle.alias("middle"), near.alias("near"))
    rules = [
        ("COLOR_GRADIENT_OVERCOMPLEX", (F.col("gradients") > MOST_GRADIENTS) | (F.col("stops") > MOST_STOPS), F.col("gradients"), MOST_GRADIENTS),
        ("COLOR_ALPHA_STACK_COMPLEX", F.col("layers") > MOST_TRANSLUCENT, F.col("layers"), MOST_TRANSLUCENT),
        ("STYLE_SURFACE_NESTING_EXCESSIVE", F.col("nested") > MOST_NESTED, F.col("nested"), MOST_NESTED),
        ("COLOR_ACCENT_OVERUSED", F.col("accents") > 3, F.col("accents"), 3),
        ("COLOR_ROLE_INCONSISTENT", (F.col("colored") >= 3) & (F.col("roles") >= 3), F.col("roles"), 2),
        ("HIERARCHY_NO_PRIMARY", (F.col("n") >= 3) & (F.col("middle") > 0) & (F.col("top") / F.col("middle") < 1.25), F.col("top") / F.col("middle"), 1.25),
        ("HIERARCHY_TOO_MANY_PRIMARY", (F.col("n") >= 2) & (F.col("near") >= 3), F.col("near"), 2),
        ("HIERARCHY_ACTION_OVER_PRIMARY", (F.col("n") >= 2) & (F.col("p_action") > 1.2 * F.col("p_content")), F.col("p_action"), F.col("p_content") * 1.2),
    ]
    found = F.array(*[F.when(when, F.struct(F.lit(code).alias("code"), actual.cast("double").alias("actual"), (F.lit(e) if not isinstance(e, Column) else e).cast("double").alias("expected"))) for code, when, actual, e in rules])
    return sums.select("doc_id", F.inline(F.filter(found, lambda x: x.isNotNull())))
