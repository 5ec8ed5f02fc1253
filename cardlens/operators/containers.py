"""Rules on a container and its children: room for lines, texts that collide, content at the edge, odd gaps.

Every container is one row that holds its children in order, so a rule is an expression over an
array, without a join of its own. What a card leaves open makes a rule silent, never guess. Cards that repeat a
row or miss an id give what their rows say; null, broken and empty cards give nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlens.operators.rounds import saved
from cardlens.operators.static import parsed
from cardlens.operators.tree import walked

# Least room left in a painted column of lines, room that others may lack, least overflow that is
# another rule's (the root's, others'); font size from which ink is large, least gap below it; least distance to an edge;
# difference of gaps that counts.
LINE_ROOM, LINE_LACK, OVERFLOW_ROOT, OVERFLOW, LARGE_INK, INK_GAP, EDGE, ODD_GAP = 8.0, 4.0, 8.0, 4.0, 20.0, 4.0, 4.0, 4.0
# The ideographs that large ink is about.
IDEOGRAPHS = r"\u3400-\u9fff\uf900-\ufaff"
EPS = 1e-9

_CHILD = ("id", "kind", "styled", "shown", "sizes", "w", "h", "margin", "font", "text", "one_line", "grows", "acts")
_OWN = ("children", "hidden", "is_root", "gap", "pad", "align", "justify", "paints", "radius", "collapsed", "text_align", "spaced", "words")


def shown(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``shown``: neither it nor what it is in is hidden. Components on or below a cycle are left out."""
    tree = nodes.select("doc_id", F.col("id").alias("node"), "parent", "hidden")
    up = walked(tree, {"hidden": (F.col("hidden"), lambda a, b: a | b)}, ["doc_id"]).filter("ended").dropDuplicates(["doc_id", "node"])
    return nodes.join(up.select("doc_id", F.col("node").alias("id"), (~F.col("hidden")).alias("shown")), ["doc_id", "id"])


def containers(nodes: DataFrame) -> DataFrame:
    """A row a component that is shown and has styles, with its children in order (``kids``; null entries for
    those that don't exist); a written table. ``nodes`` come from ``shown``."""
    kids = nodes.select("doc_id", F.col("id").alias("child"), F.struct(*_CHILD).alias("kid"))
    named = nodes.filter("shown AND styled").select("doc_id", "id", F.posexplode("children").alias("at", "child"))
    found = named.join(kids, ["doc_id", "child"], "left").groupBy("doc_id", "id").agg(F.array_sort(F.collect_list(F.struct("at", "kid"))).alias("kids"))
    rows = nodes.filter("shown AND styled").drop("children").join(found, ["doc_id", "id"], "left")
    return saved(rows.withColumn("kids", F.coalesce(F.transform("kids", lambda k: k["kid"]), F.array())))


def _sum(xs: Column, f) -> Column:
    """Sum over an array; null as soon as one value is."""
    return F.aggregate(xs, F.lit(0.0), lambda a, x: a + f(x))


def _finding(rows: DataFrame, code: Column | str, actual: Column, expected: Column | float) -> DataFrame:
    as_col = lambda x: x if isinstance(x, Column) else F.lit(x)
    return rows.select("doc_id", "id", as_col(code).alias("code"), actual.cast("double").alias("actual"), as_col(expected).cast("double").alias("expected"))


def line_room(rows: DataFrame) -> DataFrame:
    """LAYOUT_VERTICAL_DENSITY_HIGH: a column of fixed height whose three or more single lines leave less than
    8 (with a painted ground) or lack more than 4 (without one). Columns that overflow by their declared
    heights are the overflow rule's."""
    kids, pad = F.col("kids"), F.col("pad")
    n = F.size(kids)
    between = F.col("gap") * (n - 1)
    room = F.col("h") - pad["t"] - pad["b"]
    lines = F.forall(kids, lambda k: (k["kind"] == "Text") & k["styled"] & k["one_line"])
    free = room - _sum(kids, lambda k: k["font"] + k["margin"]["t"] + k["margin"]["b"]) - between
    over = _sum(kids, lambda k: F.when(~k["grows"], k["sizes"]["h"] + k["margin"]["t"] + k["margin"]["b"])) + between - room
    overflows = ~F.forall(kids, lambda k: k["acts"]) & (over + EPS >= F.when(F.col("is_root"), OVERFLOW_ROOT).otherwise(OVERFLOW))
    least = F.when(F.col("paints"), LINE_ROOM).when(free < 0, -LINE_LACK).otherwise(0.0)
    hit = (F.col("kind") == "Column") & (n >= 3) & lines & ~F.coalesce(overflows, F.lit(False)) & (free + EPS < least)
    return _finding(rows.filter(hit), "LAYOUT_VERTICAL_DENSITY_HIGH", free, least)


def ink_gaps(rows: DataFrame) -> DataFrame:
    """TEXT_COLLISION_RISK, TEXT_GAP_LOW: a large ideographic text in a box lower than its font, less than 4
    above the next text of the column; the first if nothing is between them and all of it is ideographs.
    The row is the upper text's."""
    kids = F.col("kids")
    pairs = F.zip_with(F.slice(kids, F.lit(1), F.size(kids) - 1), F.slice(kids, F.lit(2), F.size(kids)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    two = rows.filter((F.col("kind") == "Column") & (F.size(kids) >= 2)).select("doc_id", "gap", F.explode(pairs).alias("p"))
    a, b = F.col("p.a"), F.col("p.b")
    gap = F.col("gap") + a["margin"]["b"] + b["margin"]["t"]
    texts = (a["kind"] == "Text") & (b["kind"] == "Text") & a["styled"] & b["styled"]
    hit = texts & (a["font"] >= LARGE_INK) & (a["sizes"]["h"] + EPS < a["font"]) & a["text"].rlike(f"[{IDEOGRAPHS}]") & (gap + EPS < INK_GAP)
    whole = F.regexp_replace(a["text"], r"\s+", "").rlike(f"^[{IDEOGRAPHS}]+$")
    code = F.when((gap <= 0) & whole, "TEXT_COLLISION_RISK").otherwise("TEXT_GAP_LOW")
    return _finding(two.filter(hit).withColumn("id", a["id"]), code, gap, INK_GAP)


def edge_content(rows: DataFrame) -> DataFrame:
    """SURFACE_CONTENT_EDGE_CLEARANCE_LOW: texts and buttons less than 4 from the left or right edge of the
    rounded painted row or column they are in, if its padding has no effect as written or a button fills
    it; and texts with a rounded ground of their own whose padding has no effect. ``actual``: the least distance."""
    kids, pad = F.col("kids"), F.col("pad")
    surface = F.col("radius").isNotNull() & F.col("paints")
    inner = F.col("w") - pad["l"] - pad["r"]
    outer = lambda k: k["margin"]["l"] + k["w"] + k["margin"]["r"]
    some = lambda k: k["kind"].isin("Text", "Button") & k["styled"] & k["shown"]

    def crowded(k: Column, least: Column) -> Column:
        fills = (k["kind"] == "Button") & (outer(k) + 0.5 >= inner)
        return F.when(some(k) & (least + EPS < EDGE) & (F.col("collapsed") | fills), least)

    def in_row(k: Column, i: Column) -> Column:
        before = _sum(F.slice(kids, F.lit(1), i), lambda x: outer(x) + F.col("gap"))
        left = pad["l"] + before + k["margin"]["l"]
        return crowded(k, F.least(left, F.col("w") - left - k["w"]))

    def in_column(k: Column) -> Column:
        free, m = inner - outer(k), k["margin"]
        center = F.least(pad["l"] + free / 2 + m["l"], pad["r"] + free / 2 + m["r"])
        end = F.least(F.col("w") - pad["r"] - outer(k) + m["l"], pad["r"] + m["r"])
        start = F.least(pad["l"] + m["l"], F.col("w") - pad["l"] - m["l"] - k["w"])
        align = F.col("align")
        return crowded(k, F.when(align == "center", center).when(align.isin("end", "flex-end"), end).when(align.isin("start", "flex-start", ""), start))

    known = F.forall(kids, lambda k: outer(k).isNotNull()) & F.col("justify").isin("start", "flex-start") & F.col("gap").isNotNull()
    each = F.when((F.col("kind") == "Row") & known, F.transform(kids, in_row)).when(F.col("kind") == "Column", F.transform(kids, in_column))
    around = rows.filter(F.col("kind").isin("Row", "Column") & ~F.col("is_root") & surface & (inner > 0)).withColumn("least", F.array_min(each)).filter("least IS NOT NULL")
    end = F.col("text_align").isin("end", "right")
    own = (F.col("kind") == "Text") & surface & F.col("collapsed") & F.col("text_align").isin("start", "left", "end", "right") & F.col("text").isNotNull()
    clear = F.when(end, pad["r"]).otherwise(pad["l"])
    code = "SURFACE_CONTENT_EDGE_CLEARANCE_LOW"
    return _finding(around, code, F.col("least"), EDGE).unionByName(_finding(rows.filter(own & (clear + EPS < EDGE)), code, clear, EDGE))


def shape_of() -> Column:
    """A digest of a container's shape: kind, size, alignment, and kind and size of its children in order. Null
    if a size is open or grows, or a child is hidden."""
    kids = F.col("kids")
    fits = F.forall(kids, lambda k: k["styled"] & k["shown"] & ~k["grows"] & (k["sizes"]["w"].isNotNull() | ~k["sizes"]["has_w"]) & (k["sizes"]["h"].isNotNull() | ~k["sizes"]["has_h"]))
    fits = F.coalesce(fits, F.lit(False)) & F.col("kind").isin("Row", "Column") & F.col("sizes.w").isNotNull() & F.col("sizes.h").isNotNull() & ~F.col("grows") & (F.size(kids) >= 2)
    inner = F.transform(kids, lambda k: F.struct(k["kind"].alias("k"), k["sizes"]["w"].alias("w"), k["sizes"]["h"].alias("h")))
    return F.when(fits, F.sha2(F.to_json(F.struct(F.col("kind").alias("k"), F.col("sizes.w").alias("w"), F.col("sizes.h").alias("h"), F.col("words").alias("o"), inner.alias("c"))), 256))


def odd_gaps(rows: DataFrame) -> DataFrame:
    """LAYOUT_SPACING_MISSING, LAYOUT_SPACING_INCONSISTENT: of three or more containers of one shape in a card, the only
    one whose gap differs from that of all others: it has none, or differs by 4 or more."""
    alike = rows.filter("NOT spaced AND gap IS NOT NULL").select("doc_id", "id", "gap", shape_of().alias("shape")).filter("shape IS NOT NULL")
    group = Window.partitionBy("doc_id", "shape")
    ends = alike.withColumns({"lo": F.min("gap").over(group), "hi": F.max("gap").over(group)})
    counts = ends.groupBy("doc_id", "shape", "lo", "hi").agg(
        F.count("*").alias("n"), F.count_if(F.col("gap") == F.col("lo")).alias("lows"), F.count_if(F.col("gap") == F.col("hi")).alias("highs"), F.min_by("id", "gap").alias("lo_id"), F.max_by("id", "gap").alias("hi_id")
    )
    # two values, and one of them occurs once
    both = counts.filter("n >= 3 AND lo < hi AND lows + highs = n AND least(lows, highs) = 1")
    low = F.col("lows") == 1
    out = both.select("doc_id", F.when(low, F.col("lo_id")).otherwise(F.col("hi_id")).alias("id"), F.when(low, F.col("lo")).otherwise(F.col("hi")).alias("gap"), F.when(low, F.col("hi")).otherwise(F.col("lo")).alias("usual"))
    out = out.filter((F.col("usual") > 0) & ((F.col("gap") == 0) | (F.abs(F.col("gap") - F.col("usual")) >= ODD_GAP)))
    return _finding(out, F.when(F.col("gap") == 0, "LAYOUT_SPACING_MISSING").otherwise("LAYOUT_SPACING_INCONSISTENT"), F.col("gap"), F.col("usual"))


def container_findings(docs: DataFrame) -> DataFrame:
    """(doc_id, id, code, actual, expected) of all rules above, over cards (doc_id, text). Other columns are ignored."""
    rows = containers(shown(parsed(docs, (*_CHILD, *_OWN))))
    out = line_room(rows)
    for rule in (ink_gaps, edge_content, odd_gaps):
        out = out.unionByName(rule(rows))
    return out
