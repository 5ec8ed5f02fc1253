"""From card text to components, bound texts, boxes and rule diagnostics.

Everything is expressions over the text and joins keyed by (doc_id, id); what cannot be told
statically is null and never counts as a finding.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from cardlens.functions import scalars as S
from cardlens.operators import text as T
from cardlens.operators.rounds import saved
from cardlens.operators.tree import walked

_STRINGS = ("id", "component", "children", "content", "text", "label", "title", "subtitle", "placeholder", "value", "options", "items", "itemMargin", "onClick")
COMPONENT = f"struct<{','.join(f'{c}:string' for c in _STRINGS)},styles:map<string,string>>"
MESSAGE = (
    "struct<createSurface:struct<surfaceId:string,width:string,height:string>,"
    f"updateComponents:struct<root:string,components:array<{COMPONENT}>>,updateDataModel:struct<path:string,value:variant>>"
)
#: Fields that may show text, in order; the component types that show them, with the
#: fields that come first; fields of an option.
FIELDS = ("content", "text", "label", "title", "subtitle", "placeholder")
DISPLAY = {
    "button": ("content", "text", "label"),
    "checkbox": ("label",),
    "choicepicker": ("label", "title"),
    "label": (),
    "radio": ("label", "text"),
    "richtext": (),
    "select": ("label", "title", "placeholder", "value"),
    "subtitle": (),
    "tabcontent": ("title", "label"),
    "text": (),
    "textfield": ("label", "text", "placeholder", "value"),
    "textinput": ("label", "text", "placeholder", "value"),
    "title": (),
    "toggle": ("label",),
}
OPTION_FIELDS = ("label", "title", "text", "content", "value")
once = S.once
TOKENS = list(range(0, 17, 2))
MOST_CHARS = 2**31 - 1


def body_of() -> Column:
    """The messages of the column ``text``, without a mark at its start and a fence around them."""
    return once(F.when(F.col("text").startswith("﻿"), F.substring("text", 2, MOST_CHARS)).otherwise(F.col("text")), lambda x: F.trim(T.strip_fence(x, "genui")))


def messages(docs: DataFrame, message: str = MESSAGE) -> DataFrame:
    """(doc_id, messages): the messages of a text in order, whatever its encoding, each parsed
    once as a ``message``; lines that are no message are left out."""

    def found(body: Column) -> Column:
        # a plain separator and plain ends: a pattern would look at every character of a line
        lines = F.transform(F.split(body, "\n"), lambda x: F.trim(F.rtrim(x, F.lit("\r"))))
        lines = F.transform(F.filter(lines, lambda x: x.startswith("{")), lambda x: F.when(x.endswith(","), F.left(x, F.length(x) - 1)).otherwise(x))
        return F.when(body.startswith("["), F.from_json(body, f"array<{message}>")).otherwise(F.transform(lines, lambda x: F.from_json(x, message)))

    body = body_of()
    known = F.filter(once(body, found), lambda m: m["createSurface"].isNotNull() | m["updateComponents"].isNotNull() | m["updateDataModel"].isNotNull())
    return docs.select("doc_id", F.coalesce(known, F.array().cast(f"array<{message}>")).alias("messages"))


def complete(docs: DataFrame) -> DataFrame:
    """(doc_id, complete): whether all three kinds of message are there."""
    def there(op: str) -> Column:
        return F.exists("messages", lambda m: m[op].isNotNull())

    return messages(docs).select("doc_id", (there("createSurface") & there("updateComponents") & there("updateDataModel")).alias("complete"))


def unpacked(rows: DataFrame, name: str, pos: str, item: str) -> DataFrame:
    """``rows`` with (pos, item) of each entry of the array ``name``, in its place. Rows with an empty or null array go
    afterwards: for an inner explode Spark tests the array before it, and so would compute what it is made of twice."""
    return rows.select(*[c for c in rows.columns if c != name], F.posexplode_outer(name).alias(pos, item)).filter(F.col(pos).isNotNull())


def child_ids(raw: Column) -> Column:
    ids = F.coalesce(F.from_json(raw, "array<string>"), F.array(F.get_json_object(raw, "$.componentId")))
    return F.filter(ids, lambda x: x.isNotNull())


def components(msgs: DataFrame) -> DataFrame:
    """(doc_id, ord, id, kind, children, the fields that show text, options, gap, action, styles,
    declared, is_root, surface_w, surface_h, model), a row a component.

    ``declared``: the component list names it as its root. ``is_root``: the one so named; else the
    one called root; else the first that is nobody's child. ``model``: see ``data_model``.
    """
    lists = F.filter("messages", lambda m: m["updateComponents"].isNotNull())
    all_ = F.flatten(F.transform(lists, lambda m: F.coalesce(m["updateComponents"]["components"], F.array().cast(f"array<{COMPONENT}>"))))
    surfaces = F.filter("messages", lambda m: (number(m["createSurface"]["width"]) > 0) & (number(m["createSurface"]["height"]) > 0))
    rows = msgs.select(
        "doc_id", all_.alias("all"), F.transform(lists, lambda m: m["updateComponents"]["root"]).alias("roots"), F.get(surfaces, F.lit(0))["createSurface"].alias("surface"), model_of().alias("model")
    )
    rows = rows.withColumn("ids", F.transform("all", lambda c: c["id"]))
    kids = F.flatten(F.transform("all", lambda c: F.coalesce(child_ids(c["children"]), F.array().cast("array<string>"))))
    named = F.get(F.filter("roots", lambda x: F.array_contains("ids", x)), F.lit(0))
    free = F.get(F.filter(F.array_except("ids", kids), lambda x: x.isNotNull()), F.lit(0))
    root = F.coalesce(named, F.when(F.array_contains("ids", "root"), "root"), free)
    rows = unpacked(rows.select("doc_id", root.alias("root"), "roots", "surface", "model", "all"), "all", "ord", "c")
    styles = F.coalesce("c.styles", F.create_map().cast("map<string,string>"))
    gap = F.coalesce(F.nullif(number(F.col("c.itemMargin")), F.lit(0.0)), number(F.try_element_at(styles, F.lit("itemMargin"))), number(F.col("c.itemMargin")))
    action = F.coalesce(F.size(F.from_json("c.onClick", "array<string>")) > 0, F.lit(False)) | F.coalesce(F.col("c.component") == "Button", F.lit(False))
    return rows.select(
        "doc_id", "ord", "c.id", F.col("c.component").alias("kind"), F.coalesce(child_ids(F.col("c.children")), F.array().cast("array<string>")).alias("children"),
        *[f"c.{f}" for f in (*FIELDS, "value")], F.coalesce("c.options", "c.items").alias("options"), gap.alias("gap"), action.alias("action"), styles.alias("styles"),
        F.coalesce(F.array_contains("roots", F.col("c.id")), F.lit(False)).alias("declared"), F.coalesce(F.col("c.id") == F.col("root"), F.lit(False)).alias("is_root"),
        number(F.col("surface.width")).alias("surface_w"), number(F.col("surface.height")).alias("surface_h"), "model",
    )


def number(x: Column) -> Column:
    """A number with an optional unit vp, fp, dp or px; null for anything else."""
    return S.number_of(x, r"^\s*(-?[0-9]+(?:\.[0-9]+)?)(?:vp|fp|dp|px)?\s*$")


def style(name: str) -> Column:
    return number(F.element_at("styles", F.lit(name)))


def kind_of(kind: Column) -> Column:
    """The type in lower case, without its namespace."""
    return F.lower(F.trim(F.element_at(F.split(kind, r"\."), -1)))


def edges(comps: DataFrame) -> DataFrame:
    """(doc_id, parent, id, pos)."""
    return unpacked(comps.select("doc_id", F.col("id").alias("parent"), "children"), "children", "pos", "id").select("doc_id", "parent", "pos", "id")


def placed_kinds(comps: DataFrame) -> DataFrame:
    """(doc_id, id, kind, parent) of every component that is somebody's child. A component and the
    places that name it meet in one group by (doc_id, id), so the list is read once."""
    own = F.array(F.struct("id", "kind", F.lit(None).cast("string").alias("parent")))
    named = F.transform("children", lambda x: F.struct(x.alias("id"), F.lit(None).cast("string").alias("kind"), F.col("id").alias("parent")))
    rows = comps.select("doc_id", F.inline_outer(F.concat(own, named)))  # never empty; outer as in ``unpacked``
    met = rows.groupBy("doc_id", "id").agg(F.max("kind").alias("kind"), F.collect_list("parent").alias("parents"))
    return met.filter("kind IS NOT NULL").select("doc_id", "id", "kind", F.explode("parents").alias("parent"))


def placements(comps: DataFrame) -> DataFrame:
    """(doc_id, id, n, lo, hi, back): how often an id is listed, the least and greatest parent that names it, and whether
    one of them is listed no earlier than it."""
    none = F.lit(None)
    own = F.array(F.struct("id", F.col("ord").alias("own"), none.cast("string").alias("parent"), none.cast("int").alias("before")))
    named = F.transform("children", lambda x: F.struct(x.alias("id"), none.cast("int").alias("own"), F.col("id").alias("parent"), F.col("ord").alias("before")))
    met = comps.select("doc_id", F.inline_outer(F.concat(own, named))).groupBy("doc_id", "id")  # never empty; outer as in ``unpacked``
    return met.agg(F.count("own").alias("n"), F.min("parent").alias("lo"), F.max("parent").alias("hi"), (F.max("before") >= F.min("own")).alias("back"))


def backward(met: DataFrame) -> DataFrame:
    """(doc_id) of the documents of ``placements`` that may have a cycle."""
    return met.filter("back").select("doc_id").distinct()


def problems(docs: DataFrame) -> DataFrame:
    """(doc_id, reason): why a document can't be judged: no or several component lists, duplicate
    ids, unknown children, several parents, no declared root, a cycle.

    A component and the places that name it meet in one group. Cycles are looked for in documents alone that list
    some component before what names it: on a cycle there is always one.
    """
    msgs = messages(docs)
    comps = saved(components(msgs).select("doc_id", "ord", "id", "children", "declared"))
    met = saved(placements(comps).filter("n != 1 OR lo != hi OR back"))
    out = msgs.filter(F.size(F.filter("messages", lambda m: m["updateComponents"].isNotNull())) != 1).select("doc_id", F.lit("component lists").alias("reason"))
    some = comps.join(backward(met), "doc_id", "left_semi")
    up = edges(some).select("doc_id", F.col("id").alias("node"), "parent")
    tree = some.select("doc_id", F.col("id").alias("node")).join(up, ["doc_id", "node"], "left")
    for reason, rows in (
        ("duplicate id", met.filter("n > 1")),
        ("several parents", met.filter("lo != hi")),
        ("unknown child", met.filter("n = 0")),
        ("no root", comps.groupBy("doc_id").agg(F.bool_or("declared").alias("r")).filter("NOT r")),
        ("cycle", walked(tree, {}, ["doc_id"]).filter("NOT ended")),
    ):
        out = out.unionByName(rows.select("doc_id", F.lit(reason).alias("reason")).distinct())
    return out


@F.pandas_udf(StringType())
def _deep_set(writes: pd.Series) -> pd.Series:
    """The model that writes (path, value as JSON) leave when they are made one after another; null for null."""

    def model(rows) -> str | None:
        if rows is None:
            return None
        root: dict = {}
        for w in rows:
            value = json.loads(w["value"])
            keys = [k.replace("~1", "/").replace("~0", "~") for k in w["path"].strip("/").split("/")]
            if w["path"] in ("", "/"):
                root = value if isinstance(value, dict) else {"value": value}
                continue
            at = root
            for k in keys[:-1]:
                if not isinstance(at.get(k), dict):
                    at[k] = {}
                at = at[k]
            at[keys[-1]] = value
        return json.dumps(root, ensure_ascii=False)

    return writes.map(model)


def model_of() -> Column:
    """The data model of a card as JSON: one write at most one step deep is put together here, several
    go through ``_deep_set``."""
    updates = F.filter("messages", lambda m: m["updateDataModel"].isNotNull())
    writes = F.transform(
        updates, lambda m: F.struct(F.coalesce(F.nullif(m["updateDataModel"]["path"], F.lit("")), F.lit("/")).alias("path"), F.coalesce(F.to_json(m["updateDataModel"]["value"]), F.lit("{}")).alias("value"))
    )

    def put(w: Column) -> Column:
        one, path = F.get(w, F.lit(0)), F.get(w, F.lit(0))["path"]
        plain = (F.size(w) == 1) & ((path == "/") & one["value"].startswith("{") | path.rlike(r'^/[^/~"\\]+$'))
        flat = F.when(path == "/", one["value"]).otherwise(F.concat(F.lit('{"'), F.substring(path, F.lit(2), F.length(path)), F.lit('":'), one["value"], F.lit("}")))
        return F.struct(F.when(F.size(w) == 0, "{}").when(plain, flat).alias("plain"), w.alias("writes"))

    prepared = once(writes, put)
    return F.coalesce(prepared["plain"], _deep_set(F.when(prepared["plain"].isNull(), prepared["writes"])))


def data_model(msgs: DataFrame) -> DataFrame:
    """(doc_id, model): what the data model updates of a document leave, as JSON."""
    return msgs.select("doc_id", model_of().alias("model"))


def lookup(model: Column, pointer: Column) -> Column:
    """The value of JSON at a pointer, strings without quotes; null where there is none."""

    def found(p: Column) -> Column:
        steps = F.transform(F.filter(F.split(p, "/"), lambda x: x != ""), lambda x: F.replace(F.replace(x, F.lit("~1"), F.lit("/")), F.lit("~0"), F.lit("~")))
        counted = F.transform(steps, lambda x: F.when(x.rlike("^[0-9]+$"), F.concat(F.lit("["), x, F.lit("]"))).otherwise(F.concat(F.lit("['"), x, F.lit("']"))))
        read = lambda path: F.call_function("get_json_object", model, path)
        # concat_ws, as concat is slow inside of a function on arrays
        named = once(steps, lambda x: read(F.when(F.size(x) == 0, "$").otherwise(F.concat_ws("", F.lit("$['"), F.array_join(x, "']['"), F.lit("']")))))
        return F.when(p.rlike(r"/[0-9]+(/|$)"), F.coalesce(read(F.concat(F.lit("$"), F.array_join(counted, ""))), named)).otherwise(named)

    return once(pointer, found)


#: A key of JSON text with its colon, or a value that is no list or object (the group).
_VALUE = r'"(?:\\.|[^"\\])*"\s*:|("(?:\\.|[^"\\])*"|-?[0-9][-+.0-9eE]*|true|false|null)'


def shown_value(x: Column) -> Column:
    """A bound value as text: the values in a list or object, at any depth, in order and with
    spaces between them; nothing for null."""

    def plain(v: Column) -> Column:
        text = F.when(v.startswith('"'), F.get(F.from_json(F.concat(F.lit("["), v, F.lit("]")), "array<string>"), F.lit(0))).otherwise(v)
        return F.when(v == "null", "").when(v.isin("true", "false"), F.initcap(v)).otherwise(text)

    def flat(v: Column) -> Column:
        values = F.filter(F.regexp_extract_all(v, F.lit(_VALUE), F.lit(1)), lambda y: y != "")
        return F.when(v.rlike(r"^\s*[\[{]"), F.array_join(F.transform(values, plain), " ")).otherwise(F.coalesce(v, F.lit("")))

    return once(x, flat)


_DATA = r"\$__dataModel((?:\.[A-Za-z_][A-Za-z0-9_]*|\[[0-9]+\])*)"


def _pointer(expression: Column) -> Column:
    """/a/0/b of $__dataModel.a[0].b."""
    tail = F.regexp_extract(expression, _DATA, 1)
    return F.concat(F.lit("/"), F.ltrim(F.regexp_replace(F.regexp_replace(tail, r"\[([0-9]+)\]", ".$1"), r"\.", "/"), F.lit("/")))


def _expression(text: Column, model: Column) -> Column:
    """``'a' + $__dataModel.b + 1``: the parts one after another; empty if one can't be told."""
    parts = F.transform(F.regexp_extract_all(text, F.lit(r"(?:'(?:\\.|[^'\\])*'|[^+'])+"), F.lit(0)), lambda x: F.trim(x))

    def part(x: Column) -> Column:
        inner = F.substring(x, F.lit(2), F.length(x) - 2)
        return (
            F.when((F.length(x) >= 2) & x.startswith("'") & x.endswith("'"), inner)
            .when(x.startswith("${") & x.endswith("}"), shown_value(lookup(model, F.substring(x, F.lit(3), F.length(x) - 3))))
            .when(x.startswith("$__dataModel"), shown_value(lookup(model, _pointer(x))))
            .when(x.rlike(r"^-?[0-9]+(?:\.[0-9]+)?$"), F.regexp_replace(x, r"\.0$", ""))
            .when(~x.rlike(r"[$?:]"), x)
        )

    values = F.transform(F.filter(parts, lambda x: x != ""), part)
    return once(values, lambda v: F.when(F.exists(v, lambda x: x.isNull()), "").otherwise(F.array_join(v, "")))


def template(text: Column, model: Column) -> Column:
    """``{{ expression }}``, or a text with ``${/a}`` and ``$__dataModel.a`` in it."""

    def filled(x: Column, pattern: str, value) -> Column:
        names = F.sort_array(F.array_distinct(F.regexp_extract_all(x, F.lit(f"({pattern})"), F.lit(1))), asc=False)  # of two, the longer first
        return F.aggregate(names, x, lambda acc, p: F.replace(acc, p, value(p)))

    def bound(x: Column) -> Column:
        expression = F.regexp_extract(x, r"^\s*\{\{\s*(.*?)\s*\}\}\s*$", 1)
        pointers = filled(x, r"\$\{[^}]+\}", lambda p: shown_value(lookup(model, F.substring(p, F.lit(3), F.length(p) - 3))))
        data = _DATA.replace("((", "(?:(").replace(")*)", ")*)")
        plain = once(pointers, lambda y: F.when(y.contains("$__dataModel"), filled(y, data, lambda p: shown_value(lookup(model, _pointer(p))))).otherwise(y))
        return F.when(x.contains("{{") & x.rlike(r"^\s*\{\{.*\}\}\s*$"), _expression(expression, model)).when(x.contains("$"), plain).otherwise(x)

    return once(text, bound)


_DYNAMIC = "struct<path:string,call:string,args:struct<value:string>,value:string>"


def bind(text: Column, model: Column) -> Column:
    """A dynamic text with its data: a literal, a template, or an object with a path, a value or a
    call of formatString. Null for null; empty for an object that says nothing."""

    def from_object(o: Column) -> Column:
        format_ = F.when(o["call"] == "formatString", o["args"]["value"])
        path = F.coalesce(o["path"], F.get_json_object(format_, "$.path"))
        return F.when(path.isNotNull(), shown_value(lookup(model, path))).otherwise(template(F.coalesce(format_, o["value"], F.lit("")), model))

    return F.when(text.startswith("{") & ~text.startswith("{{"), once(F.from_json(text, _DYNAMIC), from_object)).otherwise(template(text, model))


def _fields(kind: Column) -> Column:
    """The fields that a component shows, in order; null if it shows none."""
    every = {name: [*first, *[f for f in FIELDS if f not in first]] for name, first in DISPLAY.items()}
    return F.try_element_at(F.create_map(*[x for name, fields in every.items() for x in (F.lit(name), F.array(*map(F.lit, fields)))]), kind)


def _raw(field: Column) -> Column:
    out = F.lit(None).cast("string")
    for f in (*FIELDS, "value"):
        out = F.when(field == f, F.col(f)).otherwise(out)
    return out


def with_texts(comps: DataFrame) -> DataFrame:
    """``comps`` with ``texts``: (field, text) of what each component should show, bound, in order,
    each text once; blank and decorative texts are left out. Options come after the fields."""
    kind = kind_of(F.col("kind"))
    own = F.transform(_fields(kind), lambda f: F.struct(f.alias("field"), _raw(f).alias("raw")))
    given = F.when(F.col("options").startswith("{"), lookup(F.col("model"), F.get_json_object("options", "$.path"))).otherwise(F.col("options"))

    def option(x: Column, i: Column) -> Column:
        at = F.concat(F.lit("options["), i.cast("string"), F.lit("]"))
        parts = F.array(*[F.struct(F.concat(at, F.lit(f".{f}")).alias("field"), F.get_json_object(x, f"$.{f}").alias("raw")) for f in OPTION_FIELDS])
        return F.when(x.startswith("{"), parts).otherwise(F.array(F.struct(at.alias("field"), x.alias("raw"))))

    options = F.when(_fields(kind).isNotNull(), F.flatten(F.transform(F.from_json(given, "array<string>"), option)))
    empty = F.array().cast("array<struct<field:string,raw:string>>")
    raw = F.filter(F.concat(F.coalesce(own, empty), F.coalesce(options, empty)), lambda x: x["raw"].isNotNull())
    bound = F.transform(raw, lambda x: F.struct(x["field"].alias("field"), T.display_texts(bind(x["raw"], F.col("model"))).alias("text")))
    shown = F.filter(bound, lambda x: x["text"].isNotNull())
    first = once(shown, lambda all_: F.filter(all_, lambda x, i: ~F.exists(F.slice(all_, 1, i), lambda y: y["text"] == x["text"])))
    return comps.withColumn("texts", first)


def required_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, id, field, text): what a card should show. A document is bound in its own row:
    nothing is joined or shuffled."""
    rows = with_texts(components(messages(docs))).select("doc_id", "id", F.inline_outer("texts"))  # outer as in ``unpacked``
    return rows.filter("field IS NOT NULL")


def box_edges(value: Column) -> Column:
    """top, right, bottom, left of a padding or margin, an array: a number, or an object with sides,
    horizontal and vertical, or all."""
    none = F.array(*[F.lit(0.0)] * 4)

    def of(v: Column) -> Column:
        get = lambda k: number(F.get_json_object(v, f"$.{k}"))
        given = F.array(*[F.coalesce(get(k), get(axis), get("all"), F.lit(0.0)) for k, axis in (("top", "vertical"), ("right", "horizontal"), ("bottom", "vertical"), ("left", "horizontal"))])
        return once(number(v), lambda n: F.when(n.isNotNull(), F.array(n, n, n, n)).when(v.contains("{"), given).otherwise(none))

    return F.when(value.isNull(), none).otherwise(once(F.trim(value), of))


def _share(value: Column) -> Column:
    return S.number_of(value, r"^\s*(-?[0-9]+(?:\.[0-9]+)?)%\s*$")


def _dimension(name: str, parent: Column) -> Column:
    return F.coalesce(parent * F.col(f"{name}_share") / 100.0, F.col(f"{name}_fixed"))


def layout(docs: DataFrame, width: float = 160.0, height: float = 160.0) -> DataFrame:
    """(doc_id, id, kind, depth, x, y, w, h): boxes from the root down, a level a round, until no
    child is left; a component inside itself is left out.

    Row and anything but Stack (as a Column) place their children one after another with
    ``itemMargin`` between, by justifyContent and alignItems; Stack centres them. Sizes that
    aren't declared: text by its length, images and dividers 24, anything else fills. Children
    with a layoutWeight share what is left. A child's margin shrinks its box.
    """
    comps = with_texts(components(messages(docs)))
    get = lambda k: F.try_element_at("styles", F.lit(k))
    sizes = {f"{k}_{n}": f(get(k)) for k in ("width", "height") for n, f in (("share", _share), ("fixed", number))}
    comps = comps.withColumns({"pad": box_edges(get("padding")), "m": box_edges(get("margin"))})
    nodes = saved(comps.select(
        "doc_id", "id", "kind", kind_of(F.col("kind")).alias("plain"), "is_root", "children", F.coalesce("gap", F.lit(0.0)).alias("gap"), *[v.alias(k) for k, v in sizes.items()],
        *[F.get(c, F.lit(i)).alias(f"{c}_{k}") for c in ("pad", "m") for i, k in enumerate("trbl")], style("layoutWeight").alias("weight"), F.coalesce(F.nullif(style("fontSize"), F.lit(0.0)), F.lit(14.0)).alias("fs"),
        F.coalesce(F.nullif(style("maxLines"), F.lit(0.0)), F.lit(1.0)).alias("lines"), F.coalesce(F.length(F.get("texts", F.lit(0))["text"]), F.lit(0)).alias("chars"),
        F.lower(F.coalesce(get("justifyContent"), F.lit("start"))).alias("justify"), F.lower(F.coalesce(get("alignItems"), F.lit("start"))).alias("align"), "surface_w", "surface_h",
    ))
    kept = ["doc_id", "id", "kind", "plain", "children", "gap", "pad_t", "pad_r", "pad_b", "pad_l", "justify", "align"]
    w, h = (F.coalesce(F.nullif(F.col(a), F.lit(0.0)), F.nullif(F.col(b), F.lit(0.0)), F.lit(c)) for a, b, c in (("surface_w", "width_fixed", width), ("surface_h", "height_fixed", height)))
    box = saved(nodes.filter("is_root").select(*kept, F.lit(0).alias("depth"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), w.alias("w"), h.alias("h"), F.array("id").alias("path")))
    found, depth = [box], 0
    kids = Window.partitionBy("doc_id", "p_path")  # a path ends with the parent
    while True:
        depth += 1
        p = box.select("doc_id", F.col("path").alias("p_path"), F.col("plain").alias("p_kind"), F.size("children").alias("n"), *[F.col(c).alias(f"p_{c}") for c in (*kept[5:], "x", "y", "w", "h")], F.posexplode("children").alias("pos", "id"))
        c = p.filter(~F.array_contains("p_path", F.col("id"))).join(nodes, ["doc_id", "id"])
        iw = F.greatest(F.lit(0.0), F.col("p_w") - F.col("p_pad_l") - F.col("p_pad_r"))
        ih = F.greatest(F.lit(0.0), F.col("p_h") - F.col("p_pad_t") - F.col("p_pad_b"))
        c = c.withColumns({"iw": iw, "ih": ih})
        kind, across, stack = F.col("plain"), F.col("p_kind") == "row", F.col("p_kind") == "stack"
        text, weighted = kind.isin("text", "button"), F.coalesce(F.col("weight") > 0, F.lit(False)) & ~stack

        def size(iw: Column, ih: Column) -> tuple[Column, Column]:
            by_text = F.least(iw, F.greatest(2 * F.col("fs"), F.col("chars") * F.col("fs") * 0.58))
            w = F.coalesce(_dimension("width", iw), F.when(text & (F.col("chars") > 0), by_text).when(kind.isin("image", "divider"), F.least(iw, F.lit(24.0))).otherwise(iw))
            h = F.coalesce(_dimension("height", ih), F.when(text, F.col("fs") * 1.25 * F.col("lines")).when(kind == "image", F.least(ih, w)).otherwise(ih))
            return F.greatest(F.lit(0.0), w), F.greatest(F.lit(0.0), h)

        w, h = size(F.col("iw"), F.col("ih"))
        c = c.withColumns({"w": w, "h": h, "weighted": weighted})
        main, room = F.when(across, F.col("w")).otherwise(F.col("h")), F.when(across, F.col("iw")).otherwise(F.col("ih"))
        gaps = F.col("p_gap") * F.greatest(F.col("n") - 1, F.lit(0))
        fixed = F.sum(F.when(F.col("weighted"), 0.0).otherwise(main)).over(kids)
        left = F.greatest(F.lit(0.0), room - fixed - gaps)
        share = left * F.col("weight") / F.greatest(F.sum(F.when(F.col("weighted"), F.col("weight")).otherwise(0.0)).over(kids), F.lit(1e-6))
        c = c.withColumn("share", share)
        w2, h2 = size(F.when(across, F.col("share")).otherwise(F.col("iw")), F.when(across, F.col("ih")).otherwise(F.col("share")))
        c = c.withColumns({
            "w": F.when(F.col("weighted"), F.when(across, F.col("share")).otherwise(w2)).otherwise(F.col("w")),
            "h": F.when(F.col("weighted"), F.when(across, h2).otherwise(F.col("share"))).otherwise(F.col("h")),
        })
        used = F.sum(main).over(kids) + gaps
        begin = F.when(F.col("p_justify").isin("center", "centre"), F.greatest(F.lit(0.0), (room - used) / 2)).when(F.col("p_justify").isin("end", "flexend", "flex-end"), F.greatest(F.lit(0.0), room - used)).otherwise(0.0)
        before = F.coalesce(F.sum(main + F.col("p_gap")).over(kids.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)) + begin

        def aligned(room: Column, size: Column) -> Column:
            free = F.greatest(F.lit(0.0), room - size)
            return F.when(stack | F.col("p_align").isin("center", "middle"), free / 2).when(F.col("p_align").isin("end", "right", "bottom", "flexend", "flex-end"), free).otherwise(0.0)

        x = F.when(across, before).otherwise(aligned(F.col("iw"), F.col("w"))) + F.col("p_x") + F.col("p_pad_l") + F.col("m_l")
        y = F.when(across | stack, aligned(F.col("ih"), F.col("h"))).otherwise(before) + F.col("p_y") + F.col("p_pad_t") + F.col("m_t")
        w = F.greatest(F.lit(0.0), F.col("w") - F.col("m_l") - F.col("m_r"))
        h = F.greatest(F.lit(0.0), F.col("h") - F.col("m_t") - F.col("m_b"))
        box = saved(c.select(*kept, F.lit(depth).alias("depth"), x.alias("x"), y.alias("y"), w.alias("w"), h.alias("h"), F.concat("p_path", F.array("id")).alias("path")))
        if box.isEmpty():
            break
        found.append(box)
    out = found[0]
    for b in found[1:]:
        out = out.unionByName(b)
    return out.select("doc_id", "id", "kind", "depth", "x", "y", "w", "h")


def hides() -> Column:
    """Whether a component's own styles hide it."""
    return F.coalesce(F.try_element_at("styles", F.lit("visibility")).isin("hidden", "none"), F.lit(False))


def hidden_components(comps: DataFrame) -> DataFrame:
    """(doc_id, id) of the components (doc_id, id, children, hidden) that aren't shown, or are below
    one that isn't. Only documents that hide something are walked."""
    tree = comps.select("doc_id", "id", "children", "hidden").join(comps.filter("hidden").select("doc_id").distinct(), "doc_id", "left_semi")
    parents = edges(tree).groupBy("doc_id", "id").agg(F.min("parent").alias("parent"))
    tree = tree.join(parents, ["doc_id", "id"], "left").select("doc_id", F.col("id").alias("node"), "parent", "hidden")
    up = walked(tree, {"hidden": (F.col("hidden"), lambda a, b: a | b)}, ["doc_id"])
    return up.filter("hidden").select("doc_id", F.col("node").alias("id")).distinct()


def shown_components(comps: DataFrame) -> DataFrame:
    """``comps`` with ``hidden`` (see ``hides``) without it and without ``hidden_components``; a written table."""
    comps = saved(comps)
    if comps.filter("hidden").isEmpty():
        return comps.drop("hidden")
    return saved(comps.join(hidden_components(comps), ["doc_id", "id"], "left_anti").drop("hidden"))


def _finding(when: Column, at: Column, code: str, severity: Column, actual: Column, expected: Column) -> Column:
    """A finding as a value of a row; null where it isn't one."""
    values = {"id": at, "code": F.lit(code), "severity": severity, "actual": actual.cast("double"), "expected": expected.cast("double")}
    return F.when(when, F.struct(*[v.alias(k) for k, v in values.items()]))


def _found(rows: DataFrame, *findings: Column) -> DataFrame:
    out = rows.select("doc_id", F.inline_outer(F.filter(F.array(*findings), lambda x: x.isNotNull())))  # outer as in ``unpacked``
    return out.filter("code IS NOT NULL")


def diagnostics(docs: DataFrame) -> DataFrame:
    """(doc_id, id, code, severity, actual, expected): what the static rules find.

    Rules: fixed sizes that overflow; low gaps between text and icon, and between rounded
    controls; text wider than its box; small action targets; spacing off the token scale; too many
    font sizes, bold texts or radii; low contrast of text on its surface. What is hidden, itself or
    by what it is in, is no part of any rule.

    Numbers, luminances and widths are read from a component's styles and text once, before it is written. A parent's
    values go along with its children, so each child meets its own row in one join, and all rules on children are one pass.
    """
    at = lambda k: F.element_at("styles", F.lit(k))
    cols = {"w": style("width"), "h": style("height"), "radius": style("borderRadius"), "fs": style("fontSize"), "weight": style("fontWeight"), "pad": style("padding")}
    shades = {"ground": S.luminance(S.parse_color(at("backgroundColor"))), "ink": S.luminance(S.parse_color(at("fontColor")))}
    comps = with_texts(components(messages(docs))).withColumn("shown", F.get("texts", F.lit(0))["text"])
    needs = S.once(F.when(F.col("kind") == "Text", F.col("shown")), lambda x: S.text_width(x, style("fontSize"), 0.35, 1.0, 0.6, 0.45))
    flat = shown_components(comps.select(
        "doc_id", "ord", "id", "kind", "children", "gap", "action", F.col("shown").isNotNull().alias("says"), needs.alias("needs"), at("backgroundColor").isNotNull().alias("painted"),
        *[v.alias(k) for k, v in (cols | shades).items()], hides().alias("hidden"),
    ))
    parent = flat.filter("id IS NOT NULL").select(
        "doc_id", F.col("ord").alias("p_ord"), F.col("id").alias("parent"), F.col("kind").alias("p_kind"), F.coalesce("gap", F.lit(0.0)).alias("p_gap"), F.col("ground").alias("p_ground"),
        *[F.col(c).alias(f"p_{c}") for c in ("w", "h", "pad")], "children",
    )
    kids = unpacked(parent, "children", "pos", "id").join(flat.drop("ord", "children", "gap", "pad", "ground"), ["doc_id", "id"])

    within = Window.partitionBy("doc_id", "p_ord", "parent")
    order = within.orderBy("pos")
    across = F.col("p_kind") == "Row"
    main = F.when(across, F.col("w")).otherwise(F.col("h"))
    kids = kids.select("*", *[F.lead(c).over(order).alias(f"n_{c}") for c in ("id", "kind", "w", "radius", "painted")], F.row_number().over(order).alias("n_th"))
    kids = kids.select("*", F.sum(main).over(within).alias("size"), F.count("*").over(within).alias("n"), F.count(main).over(within).alias("known"), F.every("action").over(within).alias("actions"))

    over = F.col("size") + F.col("p_gap") * (F.col("n") - 1) - (F.when(across, F.col("p_w")).otherwise(F.col("p_h")) - 2 * F.coalesce("p_pad", F.lit(0.0)))
    column = F.col("p_kind") == "Column"
    overflow = (F.col("n_th") == 1) & (across | column) & (F.col("n") == F.col("known")) & (over + 1e-9 >= F.when(column, 8.0).otherwise(4.0)) & ~(column & F.col("actions"))
    icons = ("Image", "Checkbox", "Icon", "SymbolGlyph")
    mixed = (F.col("kind").isin(*icons) & (F.col("n_kind") == "Text")) | ((F.col("kind") == "Text") & F.col("n_kind").isin(*icons))
    box = F.when(F.col("kind") == "Checkbox", F.col("w")).when(F.col("n_kind") == "Checkbox", F.col("n_w"))
    gap = F.col("p_gap") - F.when(box <= 16, 20.0 - box).otherwise(0.0)
    rounded = (F.col("radius") > 0) & F.col("painted") & (F.col("n_radius") > 0) & F.col("n_painted")
    text = (F.col("kind") == "Text") & F.col("says")
    ratio = F.when(F.col("ink").isNotNull() & F.col("p_ground").isNotNull(), S.contrast_of(F.col("ink"), F.col("p_ground")))
    need = F.when((F.col("fs") >= 24) | ((F.col("fs") >= 18) & (F.col("weight") >= 700)), 3.0).otherwise(4.5)
    own, warning = F.col("id"), F.lit("warning")
    by_child = _found(
        kids,
        _finding(overflow, F.col("parent"), "LAYOUT_BOUNDS_OVERFLOW", warning, over, F.lit(0)),
        _finding(across & mixed & (gap + 1e-9 < 4), own, "TEXT_ICON_GAP_LOW", warning, F.greatest(F.lit(0.0), gap), F.lit(4)),
        _finding(F.col("n_id").isNotNull() & rounded & (F.col("p_gap") + 1e-9 < 2), own, "CONTROL_GROUP_GAP_LOW", warning, F.col("p_gap"), F.lit(2)),
        _finding(text & (F.col("needs") > 1.3 * F.col("w") + 1e-9), own, "TEXT_CLIP_RISK", warning, S.rounded(F.col("needs"), 2), F.col("w")),
        _finding(text & (ratio < need), own, "COLOR_CONTRAST_LOW", F.when(ratio < 3, "error").otherwise("warning"), S.rounded(ratio, 3), need),
    )

    small = F.col("action") & ((F.col("w") < 24) | (F.col("h") < 24))
    off = lambda c: F.col(c).isNotNull() & ~F.col(c).isin([float(t) for t in TOKENS])
    by_component = _found(
        flat,
        _finding(small, own, "ACTION_TOO_SMALL", warning, F.least("w", "h"), F.lit(24)),
        *[_finding(off(c), own, "LAYOUT_SPACING_NON_TOKEN", warning, F.col(c), F.lit(None)) for c in ("gap", "pad")],
    )

    kinds = lambda x: F.size(F.collect_set(x + 0.0))  # noqa: E731 (no negative zero)
    is_text = F.col("kind") == "Text"
    levels = flat.groupBy("doc_id").agg(
        kinds(F.when(is_text, F.col("fs"))).alias("sizes"), F.count_if(is_text).alias("texts"), F.count_if(is_text & (F.col("weight") >= 700)).alias("bold"), kinds(F.when(F.col("radius") > 0, F.col("radius"))).alias("radii")
    )
    whole = F.lit("")
    by_document = _found(
        levels,
        _finding(F.col("sizes") > 3, whole, "TYPO_TOO_MANY_LEVELS", warning, F.col("sizes"), F.lit(3)),
        _finding((F.col("texts") >= 3) & (F.col("bold") == F.col("texts")), whole, "TYPO_BOLD_OVERUSED", warning, F.col("bold"), F.lit(2)),
        _finding(F.col("radii") > 3, whole, "STYLE_RADIUS_INCONSISTENT", warning, F.col("radii"), F.lit(3)),
    )
    return by_child.unionByName(by_component).unionByName(by_document)


def statuses(docs: DataFrame, findings: DataFrame, reasons: DataFrame, verdicts: DataFrame | None = None) -> DataFrame:
    """(doc_id, errors, warnings, status): fail, needs_review, pass_with_warnings or pass.

    A document that can't be judged, or with an error, fails. ``verdicts`` (doc_id, verdict) are
    assessments; one that is undetermined asks for a review where nothing failed.
    """
    sums = findings.groupBy("doc_id").agg(F.count_if(F.col("severity") == "error").alias("e"), F.count_if(F.col("severity") == "warning").alias("w"))
    bad = reasons.select("doc_id").distinct().withColumn("bad", F.lit(True))
    out = docs.select("doc_id").join(sums, "doc_id", "left").join(bad, "doc_id", "left").withColumn("open", F.lit(False))
    if verdicts is not None:
        open_ = verdicts.groupBy("doc_id").agg(F.bool_or(F.col("verdict") == "undetermined").alias("open"))
        out = out.drop("open").join(open_, "doc_id", "left")
    e, w = F.coalesce("e", F.lit(0)), F.coalesce("w", F.lit(0))
    status = F.when(F.col("bad") | (e > 0), "fail").when(F.col("open"), "needs_review").when(w > 0, "pass_with_warnings").otherwise("pass")
    return out.select("doc_id", e.alias("errors"), w.alias("warnings"), status.alias("status"))


def text_icon_verdicts(docs: DataFrame) -> DataFrame:
    """(doc_id, candidates, verdict): issue, not_applicable, undetermined or clear for checkboxes next to text."""
    comps = shown_components(components(messages(docs)).select("doc_id", "id", "kind", "children", "gap", style("width").alias("w"), hides().alias("hidden")))
    kids = edges(comps).join(comps.select("doc_id", "id", "kind", "w"), ["doc_id", "id"])
    order = Window.partitionBy("doc_id", "parent").orderBy("pos")
    pairs = kids.withColumn("n_kind", F.lead("kind").over(order)).filter("kind = 'Checkbox' AND n_kind = 'Text'")
    gaps = comps.select("doc_id", F.col("id").alias("parent"), "gap")
    pairs = pairs.join(gaps, ["doc_id", "parent"]).withColumn("free", F.col("gap") - F.when(F.col("w") <= 16, 20.0 - F.col("w")).otherwise(0.0))
    sums = pairs.groupBy("doc_id").agg(F.count("*").alias("candidates"), F.count_if(F.col("free") < 4).alias("issues"), F.count_if(F.col("free").isNull()).alias("open"))
    out = docs.select("doc_id").join(sums, "doc_id", "left").withColumn("candidates", F.coalesce("candidates", F.lit(0)))
    verdict = F.when(F.col("issues") > 0, "issue").when(F.col("candidates") == 0, "not_applicable").when(F.col("open") > 0, "undetermined").otherwise("clear")
    return out.select("doc_id", "candidates", verdict.alias("verdict"))
