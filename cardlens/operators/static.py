"""Static geometry and paint of cards, in three values: known, known not to be, and open.

What the text of a card fixes is computed; what it leaves open (a size by content, a bound text,
a picture behind a text) stays null and spreads to whatever depends on it. A component's place in
its parent depends on the parent and its children alone, so all places come from one window over
siblings, and boxes are sums of places from the root down, found by doubling (``tree.walked``).
Ancestry is a comparison of interval labels inside the joins, and boxes meet by cells of a grid.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlens.functions import scalars as S
from cardlens.operators import cards as C
from cardlens.operators.rounds import saved
from cardlens.operators.tree import intervals, walked

# Line height of a text by its font size, the least gap below it, the gap up to which
# rounded surfaces touch, the least side and radius of such a surface, the most background colours.
LINE_HEIGHT, TEXT_GAP, SURFACE_GAP, SURFACE_SIDE, SURFACE_RADIUS, MOST_COLORS = 1.25, 2.0, 0.5, 24.0, 12.0, 4096
# Spellings of justifyContent and alignItems (the second list holds for stack branches), and of alignContent.
LOOSE = {"start": ("start", "flex-start", "top", "left", ""), "center": ("center",), "end": ("end", "flex-end", "bottom", "right")}
STRICT = {"start": ("start", "flex-start"), "center": ("center",), "end": ("end", "flex-end")}
STACK = {"start": ("start", "topStart", "topLeft"), "center": ("center",), "end": ("end", "bottomEnd", "bottomRight")}
PAINT = ("backgroundColor", "linearGradient", "borderColor", "borderWidth")
COVER_FIELDS = ("width", "height", "backgroundColor", "visibility", "maxLines")
STYLES = (
    "width", "height", "padding", "margin", "justifyContent", "alignItems", "alignContent", "visibility", "borderRadius", "backgroundColor", "backgroundImage", "linearGradient", "borderColor", "borderWidth",
    "constraintSize", "layoutWeight", "flexGrow", "flexShrink", "fontColor", "fontSize", "fontWeight", "minFontSize", "maxFontSize", "maxLines", "textAlign",
)
# The columns of ``parsed`` that places and boxes, labels, overlaps, stacks and contrasts read.
PLACED = ("kind", "is_root", "hidden", "styled", "w", "h", "eh", "estimated", "pad", "margin", "gap", "justify", "align", "content")
LABELLED = ("kind", "hidden", "raw", "text", "visual")
BOXED = ("ord", "kind", "is_root", "rounded")
BRANCHED = ("kind", "w", "h", "flexible", "cover")
STACKED = (*PLACED, *LABELLED, *BRANCHED, "ground")
CONTRASTED = (*LABELLED, *BRANCHED, "layer", "shows", "styled", "ink", "font", "has_font", "smallest", "weight")
FLEXIBLE = ("constraintSize", "layoutWeight", "flexGrow", "flexShrink")

_TYPED = (
    "struct<createSurface:struct<width:variant,height:variant>,updateComponents:struct<root:string,components:array<struct<"
    "id:string,component:string,children:string,content:variant,label:variant,itemMargin:variant,space:variant,onClick:string,styles:map<string,variant>>>>,"
    "updateDataModel:struct<path:string,value:variant>>"
)
_RGBA = "array<struct<r:double,g:double,b:double,a:double>>"
_EFFECT = f"struct<op:string,clears:boolean,colors:{_RGBA}>"


# -- typed values


def typed(v: Column) -> Column:
    """struct(t, s, n) of a variant: its type (STRING, BIGINT, OBJECT<...>; VOID for JSON null), its text and its number
    (see ``numeric``); null for nothing."""
    return C.once(C.once(v, _kind_and_text), _with_number)


def _typed_map(m: Column) -> Column:
    """A map of variants, each as ``typed``. Null if a key comes twice."""
    plain = F.when(F.size(F.array_distinct(F.map_keys(m))) == F.size(m), m)
    return F.transform_values(F.transform_values(plain, lambda k, v: _kind_and_text(v)), lambda k, v: _with_number(v))


def _kind_and_text(v: Column) -> Column:
    return F.when(v.isNotNull(), F.struct(F.schema_of_variant(v).alias("t"), F.try_variant_get(v, "$", "string").alias("s")))


def _with_number(v: Column) -> Column:
    by_text = S.number_of(v["s"], r"^\s*(-?[0-9]+(?:\.[0-9]+)?)(?:vp|fp|px)?\s*$")
    n = F.when(v["t"] == "STRING", by_text).when(v["t"].rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|INT|SMALLINT|TINYINT)"), v["s"].try_cast("double"))
    return F.when(v.isNotNull(), F.struct(v["t"].alias("t"), v["s"].alias("s"), n.alias("n")))


def _string(v: Column) -> Column:
    return F.when(v["t"] == "STRING", v["s"])


def numeric(v: Column) -> Column:
    """A JSON number, or a string of one with an optional unit vp, fp or px; else null."""
    return v["n"]


def _dynamic(text: Column) -> Column:
    return F.coalesce(text.contains("{{") & text.contains("}}"), F.lit(False))


def sides(v: Column) -> Column:
    """struct(t, r, b, l) of a padding or margin as it takes effect; null where that is open.

    A number holds for all sides, an object for those it names; strings and lists have no effect.
    Percentages are open, and have no effect beside absolute values.
    """

    def box(*x: Column | float) -> Column:
        return F.struct(*[(c if isinstance(c, Column) else F.lit(c)).cast("double").alias(k) for k, c in zip("trbl", x)])

    none = box(0.0, 0.0, 0.0, 0.0)
    number, kind = numeric(v), v["t"]

    def side(raw: Column) -> Column:
        text = _string(raw)
        share = S.number_of(text, r"^\s*(-?[0-9]+(?:\.[0-9]+)?)%\s*$")
        absolute = F.greatest(F.coalesce(numeric(raw), F.lit(0.0)), F.lit(0.0))
        return F.struct(_dynamic(text).alias("open"), F.coalesce(share > 0, F.lit(False)).alias("share"), (share.isNull() & (absolute > 0)).alias("fixed"), F.when(share.isNull(), absolute).otherwise(0.0).alias("n"))

    edges = ("top", "right", "bottom", "left")
    given = F.from_json(v["s"], f"struct<{','.join(f'{n}:variant' for n in edges)}>")
    each = C.once(given, lambda g: F.transform(F.array(*[typed(g[n]) for n in edges]), side))

    def named(e: Column) -> Column:
        some = lambda f: F.exists(e, lambda x: x[f])
        return F.when(some("open"), None).when(some("fixed") & some("share"), none).when(some("share"), None).otherwise(box(*[F.get(e, F.lit(i))["n"] for i in range(4)]))

    return (
        F.when(kind.startswith("OBJECT"), C.once(each, named))
        .when(kind == "STRING", F.when(~_dynamic(_string(v)), none))
        .when(number > 0, box(number, number, number, number))
        .otherwise(none)
    )


def collapses(v: Column) -> Column:
    """Whether a padding is written in a form that has no effect: a list, a word, a negative number, an
    object without a named side, or one that mixes lengths and percentages."""
    number, kind = numeric(v), v["t"]
    given = F.from_json(F.when(kind.startswith("OBJECT"), v["s"]), "map<string,string>")
    named = F.filter(F.map_values(F.map_filter(given, lambda k, x: k.isin("top", "right", "bottom", "left"))), lambda x: x.isNotNull())
    share = F.exists(named, lambda x: F.coalesce(S.number_of(x, r"^\s*([0-9]+(?:\.[0-9]+)?)%\s*$") > 0, F.lit(False)))
    fixed = F.exists(named, lambda x: F.coalesce(S.number_of(x, r"^\s*([0-9]+(?:\.[0-9]+)?)(?:vp|fp|px)?\s*$") > 0, F.lit(False)))
    unnamed = (F.size(given) > 0) & ~F.exists(F.map_keys(given), lambda k: k.isin("top", "right", "bottom", "left"))
    odd = F.when(kind.startswith("OBJECT"), unnamed | (share & fixed)).when(kind == "STRING", ~_dynamic(v["s"])).when(kind.startswith("ARRAY") | (kind == "BOOLEAN"), True).otherwise(number < 0)
    return F.coalesce(odd, F.lit(False))


def _word(v: Column, default: str) -> Column:
    """A style that is a word; ``default`` where it is missing, empty for JSON null, ? for anything else."""
    return F.when(v.isNull(), default).when(v["t"] == "VOID", "").otherwise(F.coalesce(_string(v), F.lit("?")))


_TOKEN = r"""\$\{/[^}]+\}|'(?:\\.|[^'])*'|"(?:\\.|[^"])*"|-?[0-9]+(?:\.[0-9]+)?"""


def _static_text(raw: Column, model: Column) -> Column:
    """A text, or {{ ... }} of quoted parts, numbers and paths of the model one after another; null if open."""
    inner = F.regexp_extract(raw, r"^\s*\{\{(?s:(.*))\}\}\s*$", 1)
    parts = F.regexp_extract_all(inner, F.lit(f"({_TOKEN})"), F.lit(1))

    def part(x: Column) -> Column:
        found = C.lookup(model, F.substring(x, F.lit(3), F.length(x) - 3))
        return F.when(x.startswith("${"), F.when(~found.rlike(r"^[\[{]"), found)).when(x.rlike("^['\"]"), F.substring(x, F.lit(2), F.length(x) - 2)).otherwise(x)

    plain = (F.size(parts) > 0) & F.regexp_replace(inner, _TOKEN, "").rlike(r"^[ +()]*$")
    filled = C.once(F.transform(parts, part), lambda v: F.when(~F.exists(v, lambda x: x.isNull()), F.array_join(v, "")))
    return F.when(~_dynamic(raw), raw).when(raw.rlike(r"^\s*\{\{"), F.when(plain, filled))


def _layer() -> Column:
    """What a component paints over what is below it: taint, opaque or veil with its colours (``color``: that of its
    backgroundColor); null for nothing."""
    gradient, ground, radius = F.col("linearGradient"), F.col("backgroundColor"), F.col("borderRadius")
    stops = F.from_json(F.when(gradient["t"].startswith("OBJECT"), gradient["s"]), "struct<colors:array<variant>>")["colors"]
    pair = lambda v: F.try_variant_get(v, "$", "array<variant>")
    parsed = F.transform(stops, lambda v: F.when(F.size(pair(v)) == 2, S.parse_color(_string(typed(F.get(pair(v), F.lit(0)))))))
    colors = F.when(gradient.isNotNull(), parsed).otherwise(F.array("color"))
    corners = F.map_values(F.from_json(F.when(radius["t"].startswith("OBJECT"), radius["s"]), "map<string,string>"))
    square = radius.isNull() | (radius["t"] == "VOID") | F.coalesce(F.abs(numeric(radius)) < 1e-9, F.lit(False))
    square = square | F.coalesce(F.forall(corners, lambda x: x.isNull() | F.coalesce(C.number(x) == 0, F.lit(False))), F.lit(False))
    clears = gradient.isNull() & F.coalesce(_word(F.col("visibility"), "").isin("", "visible"), F.lit(False)) & square

    def effect(op: Column | str, c: Column) -> Column:
        return F.struct((F.lit(op) if isinstance(op, str) else op).alias("op"), F.coalesce(clears, F.lit(False)).alias("clears"), c.cast(_RGBA).alias("colors"))

    def painted(c: Column) -> Column:
        opaque = F.forall(c, lambda x: x["a"] >= 0.999)
        return F.when(c.isNull() | F.exists(c, lambda x: x.isNull()), effect("taint", F.array())).when(F.size(c) > 0, effect(F.when(opaque, "opaque").otherwise("veil"), c))

    none = F.lit(None).cast(_EFFECT)
    return F.when(F.col("backgroundImage").isNotNull(), effect("taint", F.array())).when(gradient.isNotNull() | ground.isNotNull(), C.once(colors, painted)).otherwise(none)


def parsed(docs: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """A row a component (doc_id, ord, id, kind, children, parent, pos, is_root) with the typed values
    that static rules ask for; a written table. Null and broken documents have no components.

    ``columns``: those that the caller reads besides doc_id, id, parent and pos; no others are computed.
    """
    msgs = C.messages(docs, _TYPED)
    lists = F.filter("messages", lambda m: m["updateComponents"].isNotNull())
    all_ = F.flatten(F.transform(lists, lambda m: F.coalesce(m["updateComponents"]["components"], F.array())))
    surface = F.get(F.filter("messages", lambda m: m["createSurface"].isNotNull()), F.lit(0))["createSurface"]
    rows = msgs.select("doc_id", all_.alias("all"), F.get(F.transform(lists, lambda m: m["updateComponents"]["root"]), F.lit(0)).alias("root"), surface.alias("surface"), C.model_of().alias("model"))
    rows = rows.select("doc_id", "root", *[typed(F.col("surface")[a]).alias(f"surface_{a}") for a in ("width", "height")], "model", "all")
    rows = C.unpacked(rows, "all", "ord", "c")
    # the styles that a component has, each read once from the text
    rows = rows.select(
        "doc_id", "root", "surface_width", "surface_height", "model", "ord", "c.id", F.col("c.component").alias("kind"), F.col("c.children").alias("listed"),
        *[typed(F.col(f"c.{f}")).alias(f"own_{f}") for f in ("content", "label", "itemMargin", "space")], "c.onClick", _typed_map(F.col("c.styles")).alias("styles"),
    )
    # each step computes what the next asks for more than once
    rows = rows.select("*", C.child_ids(F.col("listed")).alias("kids"), *[F.try_element_at("styles", F.lit(f)).alias(f) for f in STYLES])
    kind, styles = F.col("kind"), F.col("styles")
    is_root, has_styles = F.col("is_root"), F.col("styled")

    def size(axis: str) -> Column:
        own = F.col(axis)
        return F.coalesce(numeric(own), F.when(is_root & (_string(own) == "matchParent"), numeric(F.col(f"surface_{axis}"))))

    shown = _string(F.when(kind == "Button", F.col("own_label")).otherwise(F.col("own_content")))
    rows = rows.select(
        "*", F.coalesce(F.col("id") == F.col("root"), F.lit(False)).alias("is_root"), styles.isNotNull().alias("styled"), F.when(F.trim(shown) != "", shown).alias("raw"),
        S.parse_color(_string(F.col("backgroundColor"))).alias("color"), sides(F.col("padding")).alias("pad"), F.coalesce("kids", F.array().cast("array<string>")).alias("named"),
    )
    rows = rows.select("*", _layer().alias("layer"), size("height").alias("own_h"))
    raw, color, padding, layer = (F.col(c) for c in ("raw", "color", "pad", "layer"))
    text = _static_text(raw, F.col("model"))
    lines = F.when(F.col("maxLines").isNull(), 1.0).otherwise(numeric(F.col("maxLines")))
    font = F.coalesce(numeric(F.col("fontSize")), F.lit(16.0))
    by_lines = F.when(kind.isin("Text", "Button") & has_styles & raw.isNotNull() & (lines > 0), F.ceil(font * LINE_HEIGHT * lines + padding["t"] + padding["b"]).cast("double"))
    gap = F.col("own_itemMargin")
    bare = (kind == "Text") & (F.size("named") == 0) & F.coalesce(F.trim(_string(F.col("own_content"))) == "", F.lit(False))
    bare = bare & has_styles & (F.size(F.array_except(F.map_keys(styles), F.array(*map(F.lit, COVER_FIELDS)))) == 0) & _word(F.col("visibility"), "").isin("", "visible") & (color["a"] >= 0.999)
    # whether a text's own ground keeps off what is below it; null if that is open
    ground = (
        F.when(F.col("backgroundImage").isNotNull(), None)
        .when(F.col("backgroundColor").isNotNull(), color["a"] >= 0.999)
        .when(F.col("linearGradient").isNotNull(), F.when(layer["op"] != "taint", layer["op"] == "opaque"))
        .otherwise(False)
    )
    radius = numeric(F.col("borderRadius"))
    paints = F.lit(False)
    for f in PAINT:
        paints = paints | F.col(f).isNotNull()
    flexible, grows = F.lit(False), F.lit(False)
    for f in FLEXIBLE:
        flexible = flexible | F.col(f).isNotNull()
        grows = grows if f == "constraintSize" else grows | F.col(f).isNotNull()
    axes = F.struct(numeric(F.col("width")).alias("w"), numeric(F.col("height")).alias("h"), F.col("width").isNotNull().alias("has_w"), F.col("height").isNotNull().alias("has_h"))
    words = F.struct(F.col("justifyContent.s").alias("justify"), F.col("alignItems.s").alias("align"))
    nodes = rows.select(
        "doc_id", "ord", "id", "kind", F.col("named").alias("children"), "is_root",
        F.coalesce(_string(F.col("visibility")).isin("hidden", "none"), F.lit(False)).alias("hidden"), "styled",
        size("width").alias("w"), F.col("own_h").alias("h"), F.coalesce("own_h", by_lines).alias("eh"), (F.col("own_h").isNull() & by_lines.isNotNull()).alias("estimated"),
        "pad", F.when(has_styles, sides(F.col("margin"))).otherwise(F.struct(*[F.lit(0.0).alias(k) for k in "trbl"])).alias("margin"),
        F.when(gap.isNull(), 0.0).otherwise(numeric(gap)).alias("gap"), _word(F.col("justifyContent"), "start").alias("justify"), _word(F.col("alignItems"), "start").alias("align"),
        _word(F.col("alignContent"), "center").alias("content"), "raw", text.alias("text"), "layer", ground.alias("ground"),
        F.when(F.coalesce(bare, F.lit(False)), F.struct(color.alias("color"), _string(F.col("width")).alias("width"), _string(F.col("height")).alias("height"))).alias("cover"), flexible.alias("flexible"),
        (kind.isin("Button", "Column", "Row", "Stack", "Text") & (radius >= SURFACE_RADIUS) & ((kind == "Button") | paints)).alias("rounded"),
        ((kind == "Image") | F.col("backgroundColor").isNotNull() | F.col("backgroundImage").isNotNull() | F.col("linearGradient").isNotNull()).alias("visual"),
        S.parse_color(_string(F.col("fontColor"))).alias("ink"), numeric(F.col("fontSize")).alias("font"), F.col("fontSize").isNotNull().alias("has_font"), _smallest().alias("smallest"),
        F.coalesce(numeric(F.col("fontWeight")), _named_weight(_string(F.col("fontWeight"))), F.when(kind == "Button", 500.0).otherwise(400.0)).alias("weight"),
        F.when(kind == "Button", _shows(F.col("own_label"))).otherwise(_shows(F.col("own_content"))).alias("shows"),
        # what rules of a container and its children ask for
        axes.alias("sizes"), words.alias("words"), grows.alias("grows"), radius.alias("radius"), paints.alias("paints"), collapses(F.col("padding")).alias("collapsed"), F.col("own_space").isNotNull().alias("spaced"),
        (F.col("maxLines").isNull() | F.coalesce(numeric(F.col("maxLines")) == 1, F.lit(False)) & (F.col("maxLines.t") != "STRING")).alias("one_line"), _word(F.col("textAlign"), "start").alias("text_align"),
        (F.coalesce(F.size(F.from_json("onClick", "array<string>")) > 0, F.lit(False)) | F.coalesce(kind == "Button", F.lit(False))).alias("acts"),
    )
    kept = [c for c in nodes.columns if columns is None or c in ("doc_id", "id", *columns)]
    nodes = saved(nodes.select(*kept, *{"children"}.difference(kept)))
    parents = C.edges(nodes).groupBy("doc_id", "id").agg(F.min(F.struct("parent", "pos")).alias("in")).select("doc_id", "id", "in.parent", "in.pos")
    return saved(nodes.select(*kept).join(parents, ["doc_id", "id"], "left"))


def _shows(v: Column) -> Column:
    return F.coalesce(F.when(v["t"] == "STRING", F.trim(v["s"]) != "").otherwise(v["t"] != "VOID"), F.lit(False))


def _named_weight(name: Column) -> Column:
    from cardlens.operators.heuristics import WEIGHTS

    return F.try_element_at(F.create_map(*[F.lit(x) for kv in WEIGHTS.items() for x in kv]), name)


def _smallest() -> Column:
    """The least of minFontSize and maxFontSize; 0 if one is open; null without them."""
    each = [F.col(f) for f in ("minFontSize", "maxFontSize")]
    return F.least(*[F.when(v.isNotNull(), F.coalesce(numeric(v), F.lit(0.0))) for v in each])


# -- boxes


def _spelt(x: Column, words: dict[str, tuple[str, ...]]) -> Column:
    """start, center or end; null for what is none of them."""
    out = F.lit(None).cast("string")
    for name, spellings in words.items():
        out = F.when(x.isin(*spellings), name).otherwise(out)
    return out


def places(nodes: DataFrame, strict: bool = False) -> DataFrame:
    """(doc_id, id, parent, dx, dy, reason): where each child is in its Row, Column or Stack.

    ``reason`` says why the children of that parent have no places, all or none: padding, content
    box, child size, alignContent, itemMargin, justifyContent or alignItems that can't be told.
    Hidden children take no room. ``strict``, for branches of a stack: hidden children do, sizes
    estimated from text count as unknown, fewer spellings are known, and a negative gap is open.
    """
    own = nodes.select("doc_id", "id", "parent", "pos", "margin", "hidden", F.col("w").alias("cw"), F.col("h" if strict else "eh").alias("ch"))
    own = own.filter("parent IS NOT NULL" if strict else "parent IS NOT NULL AND NOT hidden")
    boxes = nodes.filter("kind IN ('Row', 'Column', 'Stack')").select("doc_id", F.col("id").alias("parent"), "kind", "styled", "w", F.col("h" if strict else "eh").alias("h"), "pad", "gap", "justify", "align", "content")
    kids = own.join(boxes, ["doc_id", "parent"])
    group = Window.partitionBy("doc_id", "parent")
    order = group.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    words = STRICT if strict else LOOSE
    row, stack = F.col("kind") == "Row", F.col("kind") == "Stack"
    iw, ih = F.col("w") - F.col("pad.l") - F.col("pad.r"), F.col("h") - F.col("pad.t") - F.col("pad.b")
    ow, oh = F.col("margin.l") + F.col("cw") + F.col("margin.r"), F.col("margin.t") + F.col("ch") + F.col("margin.b")
    kids = kids.withColumns({"iw": iw, "ih": ih, "ow": ow, "oh": oh, "main": F.when(row, ow).otherwise(oh), "room": F.when(row, iw).otherwise(ih)})
    kids = kids.withColumns({"n": F.count("*").over(group), "open": F.count_if(F.col("ow").isNull() | F.col("oh").isNull()).over(group), "total": F.sum("main").over(group), "before": F.coalesce(F.sum("main").over(order), F.lit(0.0)), "i": F.count("*").over(order)})
    spread = (F.col("justify") == "spaceBetween") & (F.col("n") > 1)
    gap = F.when(spread, (F.col("room") - F.col("total")) / F.when(spread, F.col("n") - 1)).otherwise(F.col("gap"))
    justify = F.when(spread, "start").otherwise(_spelt(F.col("justify"), words))
    kids = kids.withColumns({"step": gap, "j": justify, "a": _spelt(F.col("align"), words), "s": _spelt(F.col("content"), STACK)})
    free = F.col("room") - F.col("total") - F.col("step") * (F.col("n") - 1)

    def shifted(how: str, free: Column) -> Column:
        return F.when(F.col(how) == "center", free / 2.0).when(F.col(how) == "end", free).otherwise(0.0)

    along = shifted("j", free) + F.col("before") + F.col("step") * F.col("i")
    across_w, across_h = F.col("iw") - F.col("ow"), F.col("ih") - F.col("oh")
    x = F.when(stack, shifted("s", across_w)).when(row, along).otherwise(shifted("a", across_w))
    y = F.when(stack, shifted("s", across_h)).when(row, shifted("a", across_h)).otherwise(along)
    squeezed = F.lit(strict) & spread & (F.col("step") + 1e-9 < F.col("gap"))
    reason = (
        F.when(~F.col("styled"), "styles")
        .when(F.col("pad").isNull(), "padding")
        .when(F.coalesce((F.col("iw") <= 0) | (F.col("ih") <= 0), F.lit(True)), "content box")
        .when(F.col("open") > 0, "child size")
        .when(stack, F.when(F.col("s").isNull(), "alignContent"))
        .when(F.col("gap").isNull(), "itemMargin")
        .when(F.col("j").isNull() | squeezed, "justifyContent")
        .when(F.col("a").isNull(), "alignItems")
    )
    return kids.select("doc_id", "id", "parent", (x + F.col("pad.l") + F.col("margin.l")).alias("dx"), (y + F.col("pad.t") + F.col("margin.t")).alias("dy"), reason.alias("reason"))


def boxes_of(nodes: DataFrame) -> DataFrame:
    """(doc_id, id, x, y, w, h, estimated): the box of every component, null where it is open.

    A box needs a size of its own and a place in every container up to the root; the root needs a
    size. Hidden components have none. ``estimated``: the height is that of so many lines of text.
    """
    placed = places(nodes).filter("reason IS NULL").select("doc_id", "id", "dx", "dy")
    rows = nodes.join(placed, ["doc_id", "id"], "left")
    start = F.col("is_root") & F.col("parent").isNull() & F.col("w").isNotNull() & F.col("eh").isNotNull()
    tree = rows.select(
        "doc_id", F.col("id").alias("node"), "parent", "hidden", (F.col("dx").isNotNull() | start).alias("ok"), F.when(start, 0.0).otherwise(F.col("dx")).alias("x"), F.when(start, 0.0).otherwise(F.col("dy")).alias("y")
    )
    add = lambda a, b: a + b
    up = walked(tree, {"hidden": (F.col("hidden"), lambda a, b: a | b), "ok": (F.col("ok"), lambda a, b: a & b), "x": (F.col("x"), add), "y": (F.col("y"), add)}, ["doc_id"])
    up = up.filter("ended").dropDuplicates(["doc_id", "node"]).select("doc_id", F.col("node").alias("id"), (F.col("ok") & ~F.col("hidden")).alias("ok"), "x", "y")
    known = F.coalesce(F.col("ok"), F.lit(False))
    return nodes.select("doc_id", "id", "w", "eh", "estimated").join(up, ["doc_id", "id"], "left").select(
        "doc_id", "id", *[F.when(known, F.col(c)).alias(n) for c, n in (("x", "x"), ("y", "y"), ("w", "w"), ("eh", "h"))], (known & F.col("estimated")).alias("estimated")
    )


def static_layout(docs: DataFrame) -> DataFrame:
    """``boxes_of`` the components of ``docs``."""
    return boxes_of(parsed(docs, PLACED))


def labelled(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``shown`` (neither it nor what it is in is hidden), interval labels ``first`` and
    ``last``, and whether something painted, a picture or a text (also an open one) is shown in it
    (``painted``, ``pictured``, ``worded``); a written table."""
    words = (F.col("kind") == "Text") & F.col("raw").isNotNull() & F.coalesce(F.trim("text") != "", F.lit(True))
    flags = {"painted": F.col("visual"), "pictured": F.col("kind") == "Image", "worded": words}
    tree = saved(nodes.select("doc_id", F.col("id").alias("node"), "parent", "pos", "hidden", *[f.alias(n) for n, f in flags.items()]))
    up = walked(tree, {"hidden": (F.col("hidden"), lambda a, b: a | b)}, ["doc_id"]).filter("ended").dropDuplicates(["doc_id", "node"])
    tree = saved(tree.drop("hidden").join(up.select("doc_id", "node", (~F.col("hidden")).alias("shown")), ["doc_id", "node"]))
    folds = {n: ((F.col(n) & F.col("shown")).cast("int"), F.max, F.greatest) for n in flags}
    labels = intervals(tree, ["doc_id"], folds).join(tree.select("doc_id", "node", "shown"), ["doc_id", "node"])
    labels = labels.select("doc_id", F.col("node").alias("id"), "shown", "first", "last", *[(F.col(n) > 0).alias(n) for n in flags])
    return saved(nodes.join(labels, ["doc_id", "id"]))


# -- boxes that meet


def _cells(x: Column, y: Column, w: Column, h: Column, cell: Column) -> Column:
    """The cells of a grid that a box reaches. What lies far outside counts to the border cells, so a
    box has a bounded number of them."""

    def at(v: Column) -> Column:
        return F.floor(F.greatest(F.least(v / cell, F.lit(32.0)), F.lit(-16.0))).cast("int")

    xs, ys = F.sequence(at(x), F.greatest(at(x), at(x + w))), F.sequence(at(y), F.greatest(at(y), at(y + h)))
    return F.flatten(F.transform(xs, lambda i: F.transform(ys, lambda j: F.struct(i.alias("i"), j.alias("j"), at(x).alias("i0"), at(y).alias("j0")))))


def meeting(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """The rows of ``a`` and ``b`` (boxes a_x, a_y, a_w, a_h and so on, both with ``on``) whose boxes
    share a cell of a grid, each pair once. ``cell`` is the side of a cell, equal for equal ``on``."""

    def dealt(rows: DataFrame, side: str) -> DataFrame:
        cells = _cells(*[F.col(f"{side}_{c}") for c in "xywh"], F.col("cell"))
        return rows.withColumn("_c", F.explode(cells)).select("*", F.col("_c.i").alias("_i"), F.col("_c.j").alias("_j"), F.col("_c.i0").alias(f"_{side}i"), F.col("_c.j0").alias(f"_{side}j")).drop("_c")

    pairs = dealt(a, "a").join(dealt(b, "b").drop("cell"), [*on, "_i", "_j"])
    first = (F.col("_i") == F.greatest("_ai", "_bi")) & (F.col("_j") == F.greatest("_aj", "_bj"))
    return pairs.filter(first).drop("_i", "_j", "_ai", "_bi", "_aj", "_bj")


def _overlaps() -> tuple[Column, Column]:
    """How far the boxes a and b overlap in x and y; negative for a gap."""
    return tuple(F.least(F.col(f"a_{p}") + F.col(f"a_{s}"), F.col(f"b_{p}") + F.col(f"b_{s}")) - F.greatest(F.col(f"a_{p}"), F.col(f"b_{p}")) for p, s in (("x", "w"), ("y", "h")))


def _side(rows: DataFrame, side: str, reach: float, *more: str) -> DataFrame:
    """The columns of boxes under the name of a side. ``reach`` makes the box that the grid sees higher."""
    named = [F.col(c).alias(f"{side}_{c}") for c in ("id", "x", "y", "w", *more)]
    return rows.select("doc_id", *named, (F.col("h") + reach).alias(f"{side}_h"), "cell")


def _boxed(cards: DataFrame, boxes: DataFrame) -> DataFrame:
    """Shown components with a box, with the side of a grid cell for their card."""
    rows = cards.select("doc_id", "ord", "id", "kind", "parent", "is_root", "shown", "first", "last", "rounded").join(boxes.filter("x IS NOT NULL"), ["doc_id", "id"]).filter("shown")
    side = F.max(F.when(F.col("is_root"), F.greatest("w", "h"))).over(Window.partitionBy("doc_id"))
    return saved(rows.withColumn("cell", F.greatest(F.lit(32.0), side / 8.0)))


def _apart() -> Column:
    """Neither of a and b is in the other."""
    return ~F.col("a_first").between(F.col("b_first"), F.col("b_last")) & ~F.col("b_first").between(F.col("a_first"), F.col("a_last"))


def text_surface_overlaps(boxed: DataFrame) -> DataFrame:
    """(doc_id, text, target, relation, gap): texts of estimated height that reach into a rounded
    surface or a divider below, or leave less than ``TEXT_GAP`` above it; never their own ancestors."""
    texts = _side(boxed.filter("kind = 'Text' AND estimated"), "a", TEXT_GAP, "first", "last")
    targets = _side(boxed.filter("(rounded OR kind = 'Divider') AND NOT (kind = 'Text' AND estimated)"), "b", 0.0, "first", "last")
    pairs = meeting(texts, targets, ["doc_id"]).filter(_apart()).withColumn("a_h", F.col("a_h") - TEXT_GAP)
    wide, high = _overlaps()
    gap = F.col("b_y") - F.col("a_y") - F.col("a_h")
    relation = F.when(wide > 0.5, F.when(high > 0.5, "overlap").when((gap >= 0) & (gap < TEXT_GAP), "low_gap"))
    found = pairs.select("doc_id", F.col("a_id").alias("text"), F.col("b_id").alias("target"), relation.alias("relation"), F.when(high > 0.5, -high).otherwise(gap).alias("gap"))
    return found.filter("relation IS NOT NULL")


def touching_surfaces(boxed: DataFrame) -> DataFrame:
    """(doc_id, a, b, axis, gap): rounded surfaces of different parents, neither in the other, that
    touch or overlap; a comes first in the component list."""
    rows = boxed.filter("rounded AND NOT is_root").filter(F.least("w", "h") + 1e-9 >= SURFACE_SIDE)
    grown = rows.withColumns({"x": F.col("x") - SURFACE_GAP, "y": F.col("y") - SURFACE_GAP, "w": F.col("w") + 2 * SURFACE_GAP})
    sides_ = [_side(grown, s, 2 * SURFACE_GAP, "first", "last", "parent", "ord") for s in "ab"]
    pairs = meeting(*sides_, ["doc_id"]).filter((F.col("a_ord") < F.col("b_ord")) & _apart() & ~F.col("a_parent").eqNullSafe(F.col("b_parent")))
    wide, high = (o - 2 * SURFACE_GAP for o in _overlaps())
    axis = F.when(high > 0.5, "horizontal").when(wide > 0.5, "vertical")
    gap = F.greatest(F.lit(0.0), F.when(high > 0.5, -wide).otherwise(-high))
    return pairs.select("doc_id", F.col("a_id").alias("a"), F.col("b_id").alias("b"), axis.alias("axis"), gap.alias("gap")).filter(F.col("axis").isNotNull() & (F.col("gap") <= SURFACE_GAP + 1e-9))


# -- pictures over texts in stacks


def _branches(cards: DataFrame) -> DataFrame:
    """(doc_id, stack, id, pos, covers): the children of stacks; how many siblings before each are
    opaque plain layers of the stack's size."""
    stacks = cards.filter("kind = 'Stack' AND shown").select("doc_id", F.col("id").alias("stack"), F.col("w").alias("sw"), F.col("h").alias("sh"), F.col("flexible").alias("loose"))
    kids = cards.filter("parent IS NOT NULL").select("doc_id", F.col("parent").alias("stack"), "id", "pos", "w", "h", "cover", "pictured", "worded", "painted", "shown").join(stacks, ["doc_id", "stack"])

    def spans(axis: str, own: str, room: str) -> Column:
        return F.col(f"cover.{axis}").isin("matchParent", "100%") | (~F.col("loose") & (F.col(own) >= F.col(room)))

    full = F.col("cover").isNotNull() & F.coalesce(spans("width", "w", "sw") & spans("height", "h", "sh"), F.lit(False))
    before = Window.partitionBy("doc_id", "stack").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    kids = kids.withColumn("full", full)
    effect = F.struct(F.col("full"), F.when(F.col("full"), F.col("cover.color")).alias("color"))
    return kids.select("doc_id", "stack", "id", "pos", "pictured", "worded", F.count_if("full").over(before).alias("covers"), F.last(F.when(F.col("painted") & F.col("shown"), effect), ignorenulls=True).over(before).alias("below"))


def stack_overlaps(cards: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, stack, image, text, wide, high): pictures and texts of different branches of a stack
    whose boxes meet; and (doc_id, stack, open, candidate): every shown stack, whether its boxes can't be told,
    and whether a picture could reach a text in it.

    A branch is what lies below a child of the stack, through rows and columns only; another stack
    or kind in it leaves the stack open. A text with an opaque ground of its own, or a full opaque layer
    between, keeps pictures below it away.
    """
    branches = saved(_branches(cards))
    placed = places(cards, strict=True)
    reasons = placed.groupBy("doc_id", F.col("parent").alias("id")).agg(F.max("reason").alias("reason"))
    rows = cards.join(placed.filter("reason IS NULL").select("doc_id", "id", "dx", "dy"), ["doc_id", "id"], "left").join(reasons, ["doc_id", "id"], "left")
    ground = F.col("ground")
    wordless = F.col("raw").isNotNull() & F.col("text").isNull()
    inner = (F.col("w") - F.col("pad.l") - F.col("pad.r") > 0) & (F.col("h") - F.col("pad.t") - F.col("pad.b") > 0)
    box = F.coalesce(inner, F.lit(False)) & F.col("reason").isNull()
    bad = ~F.col("styled") | ~F.when(F.col("kind") == "Image", True).when(F.col("kind") == "Text", ground.isNotNull() & ~wordless).when(F.col("kind").isin("Row", "Column"), box).otherwise(False)
    tops = cards.filter("kind = 'Stack'").select("doc_id", F.col("id").alias("parent"), F.lit(True).alias("top"))
    rows = rows.join(tops, ["doc_id", "parent"], "left")
    none = F.lit(None).cast("string")
    base = lambda x: F.concat(F.lit("stack "), x)
    zero = F.lit(0.0)
    tree = rows.select(
        "doc_id", F.concat(F.lit("node "), F.col("id")).alias("node"), F.when(F.col("top"), base(F.col("parent"))).otherwise(F.concat(F.lit("node "), F.col("parent"))).alias("parent"),
        "hidden", F.col("dx").alias("x"), F.col("dy").alias("y"), none.alias("stack"), F.when(F.col("top"), F.col("id")).alias("branch"),
    )
    roots = cards.filter("kind = 'Stack'").select("doc_id", base(F.col("id")).alias("node"), none.alias("parent"), F.lit(False).alias("hidden"), zero.alias("x"), zero.alias("y"), F.col("id").alias("stack"), none.alias("branch"))
    either = lambda a, b: F.coalesce(a, b)
    add = lambda a, b: a + b
    values = {"hidden": (F.col("hidden"), lambda a, b: a | b), "x": (F.col("x"), add), "y": (F.col("y"), add), "stack": (F.col("stack"), either), "branch": (F.col("branch"), either)}
    up = walked(tree.unionByName(roots), values, ["doc_id"]).filter("ended AND NOT hidden AND stack IS NOT NULL AND branch IS NOT NULL")
    up = up.select("doc_id", F.substring("node", F.lit(6), F.length("node")).alias("id"), "x", "y", "stack", "branch")
    state = rows.select("doc_id", "id", "kind", "w", "h", "text", bad.alias("bad"), F.coalesce(ground, F.lit(False)).alias("ground"), box.alias("box"))
    inside = saved(up.join(state, ["doc_id", "id"]))
    faults = inside.filter("bad").select("doc_id", "stack").union(state.filter("kind = 'Stack' AND NOT box").select("doc_id", F.col("id").alias("stack"))).distinct().withColumn("open", F.lit(True))
    stacks = cards.filter("kind = 'Stack' AND shown").select("doc_id", F.col("id").alias("stack"), F.greatest(F.lit(32.0), F.greatest("w", "h") / 8.0).alias("cell"))
    stacks = saved(stacks.join(faults, ["doc_id", "stack"], "left").withColumn("open", F.coalesce("open", F.lit(False))))

    at = branches.select("doc_id", "stack", F.col("id").alias("branch"), "pos", "covers")
    leaves = inside.join(stacks.filter("NOT open").select("doc_id", "stack", "cell"), ["doc_id", "stack"]).join(at, ["doc_id", "stack", "branch"])
    leaf = lambda side: [F.col(c).alias(f"{side}_{c}") for c in ("id", "x", "y", "w", "h", "branch", "pos", "covers", "ground")]
    images = leaves.filter("kind = 'Image'").select("doc_id", "stack", "cell", *leaf("a"))
    texts = leaves.filter(F.expr("kind = 'Text'") & (F.trim("text") != "")).select("doc_id", "stack", "cell", *leaf("b"))
    below = F.col("a_pos") < F.col("b_pos")
    kept_off = below & (F.col("b_ground") | (F.col("b_covers") > F.col("a_covers")))
    wide, high = _overlaps()
    found = meeting(images, texts, ["doc_id", "stack"]).filter((F.col("a_branch") != F.col("b_branch")) & ~kept_off).withColumns({"wide": wide, "high": high})
    found = found.filter("wide > 0.5 AND high > 0.5").select("doc_id", "stack", F.col("a_id").alias("image"), F.col("b_id").alias("text"), "wide", "high")

    # a picture reaches a text if it is painted later, or earlier with as many full layers below it
    levels = branches.groupBy("doc_id", "stack", "covers").agg(
        *[F.count_if(c).cast("int").alias(n) for n, c in (("p", F.col("pictured")), ("t", F.col("worded")), ("both", F.col("pictured") & F.col("worded")))],
        F.max(F.when(F.col("pictured"), F.col("pos"))).alias("p_last"), F.min(F.when(F.col("worded"), F.col("pos"))).alias("t_first"),
    )
    level = (F.col("p") > 0) & (F.col("t") > 0) & ~((F.col("p") == 1) & (F.col("t") == 1) & (F.col("both") == 1))
    sums = levels.groupBy("doc_id", "stack").agg((F.bool_or(level) | F.coalesce(F.max("p_last") > F.min("t_first"), F.lit(False))).alias("candidate"))
    stacks = stacks.join(sums, ["doc_id", "stack"], "left").select("doc_id", "stack", "open", F.coalesce("candidate", F.lit(False)).alias("candidate"))
    return found, stacks


def stack_verdicts(docs: DataFrame, found: DataFrame, stacks: DataFrame) -> DataFrame:
    """(doc_id, candidates, verdict): issue, not_applicable, undetermined or clear for pictures over texts."""
    sums = stacks.filter("candidate").groupBy("doc_id").agg(F.count("*").alias("candidates"), F.bool_or("open").alias("open"))
    out = docs.select("doc_id").join(sums, "doc_id", "left").join(found.select("doc_id", F.lit(True).alias("issue")).distinct(), "doc_id", "left")
    verdict = F.when(F.col("issue"), "issue").when(F.col("candidates").isNull(), "not_applicable").when(F.col("open"), "undetermined").otherwise("clear")
    return out.select("doc_id", F.coalesce("candidates", F.lit(0)).alias("candidates"), verdict.alias("verdict"))


# -- backgrounds


def backgrounds(cards: DataFrame) -> DataFrame:
    """(doc_id, id, colors): every colour that may lie behind a component, its own ground included;
    null where that is open.

    What is painted from the root down is a list of effects, put together by doubling and then applied
    in order: an opaque ground replaces what was there, a veil is laid over each colour, a picture or an
    unreadable colour leaves it open until a plain square ground covers it. In a stack the
    last painted sibling before the branch counts, too: a full opaque layer is a ground, anything else
    leaves it open. More than ``MOST_COLORS`` colours are open as well.
    """
    empty = F.array().cast(f"array<{_EFFECT}>")
    below = _branches(cards).select("doc_id", "id", "below")
    cover = F.when(F.col("below.full"), F.struct(F.lit("cover").alias("op"), F.lit(True).alias("clears"), F.array("below.color").cast(_RGBA).alias("colors"))).otherwise(
        F.struct(F.lit("taint").alias("op"), F.lit(False).alias("clears"), F.array().cast(_RGBA).alias("colors"))
    )
    under = F.when(F.col("below").isNotNull(), F.array(cover)).otherwise(empty)
    own = F.when(F.col("layer").isNotNull(), F.array("layer")).otherwise(empty)
    rows = cards.join(below, ["doc_id", "id"], "left").select("doc_id", F.col("id").alias("node"), "parent", F.concat(under, own).alias("effects"))
    up = walked(rows, {"effects": (F.col("effects"), lambda a, b: F.concat(b, a))}, ["doc_id"]).filter("ended").dropDuplicates(["doc_id", "node"])

    def state(known: Column | bool, taint: Column | bool, colors: Column) -> Column:
        of = lambda v: v if isinstance(v, Column) else F.lit(v)
        return F.struct(of(known).alias("known"), of(taint).alias("taint"), colors.cast(_RGBA).alias("colors"))

    def step(s: Column, e: Column) -> Column:
        veiled = F.flatten(F.transform(e["colors"], lambda top: F.transform(s["colors"], lambda bottom: S.composite(top, bottom))))
        ground = F.when(s["taint"] & ~e["clears"] | (F.size(e["colors"]) > MOST_COLORS), state(False, True, F.array())).otherwise(state(True, False, e["colors"]))
        veil = F.when(s["known"] & (F.size(e["colors"]) * F.size(s["colors"]) <= MOST_COLORS), state(True, False, veiled)).otherwise(state(False, True, F.array()))
        return F.when(e["op"] == "cover", state(True, False, e["colors"])).when(e["op"] == "opaque", ground).when(e["op"] == "veil", veil).otherwise(state(False, True, F.array()))

    done = F.aggregate("effects", state(False, False, F.array()), step)
    return up.select("doc_id", F.col("node").alias("id"), done.alias("s")).select("doc_id", "id", F.when(F.col("s.known"), F.col("s.colors")).alias("colors"))


def contrasts(cards: DataFrame) -> DataFrame:
    """(doc_id, id, state, lowest, highest, required): the contrast of every shown text with all that may
    lie behind it: low (error below 3), warning, clear, or open.

    Open: an unreadable font colour or size, no known ground, or grounds of which only some are enough.
    """
    texts = cards.filter("kind IN ('Text', 'Button') AND shows AND styled AND shown").select("doc_id", "id", "ink", "font", "has_font", "smallest", "weight")
    rows = texts.join(backgrounds(cards), ["doc_id", "id"], "left")
    grounds = F.filter("colors", lambda c: c["a"] >= 0.999)
    ratios = F.transform(grounds, lambda c: S.contrast_ratio(S.composite(F.col("ink"), c), c))
    rows = rows.withColumn("ratios", ratios)
    size = F.coalesce("font", F.lit(16.0))
    size = F.least(size, F.coalesce("smallest", size))
    required = F.when((size >= 18.0) | ((size >= 14.0) & (F.col("weight") >= 700.0)), 3.0).otherwise(4.5)
    rows = rows.withColumns({"lowest": F.array_min("ratios"), "highest": F.array_max("ratios"), "required": required})
    open_ = F.col("ink").isNull() | F.col("lowest").isNull() | (F.col("has_font") & F.col("font").isNull()) | ((F.col("lowest") < F.col("required")) & (F.col("highest") >= F.col("required")))
    state = F.when(open_, "open").when(F.col("lowest") >= F.col("required"), "clear").when(F.col("lowest") < 3.0, "error").otherwise("warning")
    return rows.select("doc_id", "id", state.alias("state"), "lowest", "highest", "required")
