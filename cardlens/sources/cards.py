"""Card documents: readers of DSL text, and cards derived from orders.

A card document is text: a JSON array of messages, one message a line, or either inside a
fenced block. ``read_documents`` reads such files; ``card_documents`` writes one for each order,
so that parsing, layout and rules have input that grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardlens.sources.adapters import table


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, path, text) of every file below ``path``; the id is a hash of the path."""
    rows = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).withColumn("path", F.input_file_name())
    return rows.select(F.xxhash64("path").alias("doc_id"), "path", F.regexp_replace("value", "^﻿", "").alias("text"))


def read_prompts(spark: SparkSession, path: str) -> DataFrame:
    """(qid, query) of a prompt file: JSON lines with qid or id, query or text; other lines are prompts
    themselves under the name of their line. Blank lines and lines without a prompt are left out."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("n", "line"))
    line = F.trim(F.regexp_replace("line", "^﻿", ""))
    get = lambda k: F.nullif(F.get_json_object("line", f"$.{k}"), F.lit(""))
    is_json = F.col("line").startswith("{")
    qid = F.coalesce(F.when(is_json, F.coalesce(get("qid"), get("id"))), F.concat(F.lit("q"), (F.col("n") + 1).cast("string")))
    query = F.when(is_json, F.coalesce(get("query"), get("text"))).otherwise(F.col("line"))
    return lines.withColumn("line", line).filter("line != ''").select(qid.alias("qid"), query.alias("query")).filter("query IS NOT NULL")


def card_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each line of an order, numbered, with what its components are made of."""
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("doc_id"),
        F.row_number().over(order).cast("long").alias("ord"),
        F.col("l_linenumber").cast("long").alias("line"),
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supp"),
        F.when(F.col("l_returnflag") == "R", "Checkbox").when(F.col("l_returnflag") == "A", "Image").otherwise("Button").alias("lead"),
    )


ITEMS = """(SELECT l_orderkey AS doc_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS ord,
  CAST(l_linenumber AS BIGINT) AS line, l_partkey AS part, l_suppkey AS supp, CASE l_returnflag WHEN 'R' THEN 'Checkbox' WHEN 'A' THEN 'Image' ELSE 'Button' END AS lead FROM lineitem)"""


def _hex(n: Column) -> Column:
    return F.concat(F.lit("#"), F.lpad(F.hex(F.pmod(n * 7919, F.lit(16777216))), 6, "0"))


def card_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text): a card for each order, in one of three encodings.

    A root Column holds a Row for each line of the order; a Row holds a control and a Text whose
    content is a literal, a template, or a pointer into the data model.
    """
    s = lambda c: c.cast("string")
    none = F.lit(None).cast("string")

    def component(name: Column, kind: Column | str, children: Column | None, content: Column | None, label: Column | None, gap: Column | None, action: Column | None, styles: dict[str, Column]) -> Column:
        fields = {
            "id": name, "component": F.lit(kind) if isinstance(kind, str) else kind, "children": children if children is not None else F.lit(None).cast("array<string>"),
            "content": none if content is None else content, "label": none if label is None else label, "itemMargin": F.lit(None).cast("long") if gap is None else gap,
            "onClick": F.lit(None).cast("array<string>") if action is None else action,
        }
        keys = ("width", "height", "padding", "borderRadius", "backgroundColor", "fontSize", "fontWeight", "fontColor", "maxLines")
        fields["styles"] = F.struct(*[s(styles[k]).alias(k) if k in styles else none.alias(k) for k in keys])
        return F.struct(*[v.alias(k) for k, v in fields.items()])

    o = s(F.col("ord"))
    row, lead, text = (F.concat(F.lit(p), o) for p in "wit")
    content = F.when(F.col("ord") % 3 == 0, F.concat(F.lit("item "), s(F.col("line")))).when(F.col("ord") % 3 == 1, F.lit("status ${/o/status}")).otherwise(F.lit("{{ $__dataModel.o.total }}"))
    button = F.col("lead") == "Button"
    side = 12 + F.col("part") % 12
    parts = F.array(
        component(row, "Row", F.array(lead, text), None, None, F.col("supp") % 8, None,
            {"width": 60 + 4 * F.col("line"), "height": 12 + 4 * F.col("line"), "borderRadius": F.col("supp") % 24, "backgroundColor": _hex(F.col("part"))}),
        component(lead, F.col("lead"), None, None, F.when(button, "Go"), None, F.when(button, F.array(F.lit("open"))), {"width": side, "height": side}),
        component(text, "Text", None, content, None, None, None,
            {"width": 20 + F.col("part") % 60, "fontSize": 8 + 2 * F.col("line"), "fontWeight": F.when(F.col("supp") % 2 == 0, 700).otherwise(400), "fontColor": _hex(F.col("supp")), "maxLines": F.lit(1)}),
    )
    cards = card_items(spark, sf_dir).groupBy("doc_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("ord", parts.alias("parts")))), lambda x: x["parts"]).alias("parts"),
        F.transform(F.array_sort(F.collect_list("ord")), lambda x: F.concat(F.lit("w"), x.cast("string"))).alias("rows"),
    )
    head = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.col("o_orderstatus").alias("status"), F.floor("o_totalprice").cast("long").alias("total"))
    root = component(F.lit("root"), "Column", F.col("rows"), None, None, F.col("doc_id") % 3 * 4, None,
        {"width": F.lit(160), "height": F.lit(160), "padding": F.lit(8), "borderRadius": F.lit(16), "backgroundColor": F.lit("#FFFFFF")})
    cards = cards.join(head, "doc_id")
    version = F.lit("v0.9").alias("version")
    surface = F.to_json(F.struct(version, F.struct(F.lit("s").alias("surfaceId"), F.lit(160).alias("width"), F.lit(160).alias("height")).alias("createSurface")))
    update = F.to_json(F.struct(version, F.struct(F.lit("s").alias("surfaceId"), F.lit("root").alias("root"), F.concat(F.array(root), F.flatten("parts")).alias("components")).alias("updateComponents")))
    model = F.to_json(F.struct(version, F.struct(F.lit("/o").alias("path"), F.struct("status", "total").alias("value")).alias("updateDataModel")))
    array = F.concat(F.lit("["), F.concat_ws(",", surface, update, model), F.lit("]"))
    lines = F.concat_ws("\n", surface, update, model)
    text = F.when(F.col("doc_id") % 3 == 0, array).when(F.col("doc_id") % 3 == 1, lines).otherwise(F.concat(F.lit("Here it is:\n```genui\n"), lines, F.lit("\n```\nDone.")))
    return cards.select("doc_id", text.alias("text"))


def layered_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text): a card for each order whose lines are stacks of a picture and a text.

    A line's text comes before or after its picture, sometimes with a full layer between; some pictures
    are hidden, some texts say nothing of their height, some stacks are aligned by an unknown word or
    painted with a veil, a gradient or a picture. A rounded footer follows the lines.
    """
    s = lambda c: c.cast("string")
    num = lambda c: c.cast("long")
    none = F.lit(None).cast("string")
    keys = {"width": "string", "height": "string", "padding": "long", "alignContent": "string", "visibility": "string", "backgroundColor": "string", "backgroundImage": "string", "fontColor": "string", "borderRadius": "long",
            "linearGradient": "struct<colors:array<array<string>>>"}

    def component(name: Column, kind: str, children: Column | None = None, content: Column | None = None, gap: Column | None = None, **styles: Column) -> Column:
        style = F.struct(*[(styles[k] if k in styles else F.lit(None)).cast(t).alias(k) for k, t in keys.items()])
        fields = {"id": name, "component": F.lit(kind), "children": children if children is not None else F.lit(None).cast("array<string>"), "content": none if content is None else content,
                  "itemMargin": F.lit(None).cast("long") if gap is None else gap, "styles": style}
        return F.struct(*[v.alias(k) for k, v in fields.items()])

    part, supp, line = F.col("part"), F.col("supp"), F.col("line")
    stack, image, text, layer = (F.concat(F.lit(p), s(F.col("ord"))) for p in "smtc")
    covered = line % 3 == 0
    order = F.when(supp % 2 == 1, F.array(text, image)).when(covered, F.array(image, layer, text)).otherwise(F.array(image, text))
    align = F.when(supp % 8 == 5, "weird").when(supp % 4 == 1, "start").when(supp % 4 == 2, "end")
    paint = part % 5
    gradient = F.when(paint == 2, F.struct(F.array(F.array(_hex(part), F.lit("0")), F.array(_hex(part + 1), F.lit("1"))).alias("colors")))
    ground = F.when(paint == 0, _hex(part)).when(paint == 1, F.concat(F.lit("#80"), F.substring(_hex(part), 2, 6)))
    w, h = num(90 + 4 * line), num(40 + 2 * line)
    boxes = F.array(
        component(stack, "Stack", order, width=w, height=h, padding=num(part % 3 * 2), alignContent=align, backgroundColor=ground, linearGradient=gradient, backgroundImage=F.when(paint == 3, "a.png")),
        component(image, "Image", width=num(20 + part % 30), height=num(16 + part % 20), visibility=F.when(part % 7 == 0, "hidden")),
        component(text, "Text", None, F.concat(F.lit("item "), s(line)), width=num(30 + supp % 40), height=F.when(part % 4 != 0, 18), fontColor=_hex(supp)),
    )
    extra = F.when(covered & (supp % 2 == 0), F.array(component(layer, "Text", None, F.lit(""), width=F.lit("100%"), height=F.lit("matchParent"), backgroundColor=_hex(part + 2))))
    parts = F.concat(boxes, F.coalesce(extra, F.array()))
    cards = card_items(spark, sf_dir).groupBy("doc_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("ord", parts.alias("parts")))), lambda x: x["parts"]).alias("parts"),
        F.transform(F.array_sort(F.collect_list("ord")), lambda x: F.concat(F.lit("s"), x.cast("string"))).alias("rows"),
    )
    root = component(F.lit("root"), "Column", F.concat(F.col("rows"), F.array(F.lit("foot"))), None, num(F.col("doc_id") % 3), width=F.lit("matchParent"), height=F.lit("matchParent"), backgroundColor=F.lit("#FFFFFF"))
    foot = component(F.lit("foot"), "Row", F.array().cast("array<string>"), width=num(F.lit(100)), height=num(F.lit(30)), backgroundColor=F.lit("#EEEEEE"), borderRadius=num(F.lit(12)))
    surface = F.to_json(F.struct(F.struct(F.lit("s").alias("surfaceId"), F.lit(160).alias("width"), F.lit(600).alias("height")).alias("createSurface")))
    update = F.to_json(F.struct(F.struct(F.lit("s").alias("surfaceId"), F.lit("root").alias("root"), F.concat(F.array(root), F.flatten("parts"), F.array(foot)).alias("components")).alias("updateComponents")))
    return cards.select("doc_id", F.concat_ws("\n", surface, update).alias("text"))


def tiled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text): a card for each order whose lines are a row of a button and a text, and a column of three texts.

    Rows come in two shapes and with three gaps, some with padding as a list; columns are of any height, some painted,
    some hidden; their first text is large and ideographic, its box lower than its font or not.
    """
    part, supp, line, o = F.col("part"), F.col("supp"), F.col("line"), F.col("ord")
    gap = F.when(part % 9 == 0, 0).when(part % 9 == 1, 20).otherwise(8)
    row = F.format_string(
        '{"id":"r%d","component":"Row","children":["b%d","t%d"],"itemMargin":%d,"styles":{"width":120,"height":30,"borderRadius":8,"backgroundColor":"#EEEEEE","padding":%s}},'
        '{"id":"b%d","component":"Button","label":"Go","styles":{"width":%d,"height":20}},{"id":"t%d","component":"Text","content":"note","styles":{"width":30,"height":16}}',
        o, o, o, gap, F.when(part % 3 == 0, "[8,8]").otherwise("8"), o, F.when(supp % 5 == 0, 110).otherwise(50), o,
    )
    font = 10 + 2 * line
    low = F.when(line % 2 == 0, ',"height":12').otherwise("")
    column = F.format_string(
        '{"id":"c%d","component":"Column","children":["l%d","m%d","n%d"],"itemMargin":%d,"styles":{"width":100,"height":%d,"padding":4%s%s}},'
        '{"id":"l%d","component":"Text","content":"%s","styles":{"fontSize":%d,"height":%d}},{"id":"m%d","component":"Text","content":"two","styles":{"fontSize":12,"margin":{"top":%d}%s}},'
        '{"id":"n%d","component":"Text","content":"three","styles":{"fontSize":"12vp","maxLines":1%s}}',
        o, o, o, o, supp % 6, 50 + part % 40, F.when(supp % 3 == 0, ',"backgroundColor":"#DDDDDD"').otherwise(""), F.when(part % 7 == 0, ',"visibility":"hidden"').otherwise(""),
        o, F.when(part % 2 == 0, "标题").otherwise("标题A"), font, font - supp % 4, o, line % 3, low, o, low,
    )
    items = card_items(spark, sf_dir).select("doc_id", "ord", F.concat_ws(",", row, column).alias("parts"))
    cards = items.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("ord", "parts"))).alias("p"))
    names = F.array_join(F.flatten(F.transform("p", lambda x: F.array(F.concat(F.lit('"r'), x["ord"].cast("string"), F.lit('"')), F.concat(F.lit('"c'), x["ord"].cast("string"), F.lit('"'))))), ",")
    update = F.concat(
        F.lit('{"updateComponents":{"surfaceId":"s","root":"root","components":[{"id":"root","component":"Column","children":['), names, F.lit('],"styles":{"width":"matchParent","height":"matchParent"}},'),
        F.array_join(F.transform("p", lambda x: x["parts"]), ","), F.lit("]}}"),
    )
    return cards.select("doc_id", F.concat(F.lit('{"createSurface":{"surfaceId":"s","width":160,"height":900}}\n'), update).alias("text"))
