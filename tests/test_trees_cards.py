"""Trees of any depth, and cards: expressions, display fields, roots, margins, deep layouts."""

import json

import pytest
from pyspark.sql import functions as F

from cardlens.operators import cards as C
from cardlens.operators import tree as R


def tree(spark, rows):
    return spark.createDataFrame(rows, "node string, parent string, pos long, flag boolean")


def test_a_long_chain(spark):
    t = tree(spark, [(f"n{i}", f"n{i - 1}" if i else None, 0, i == 7) for i in range(500)])
    got = R.closure(t).groupBy("node").agg(F.count("*").alias("n"), F.max("distance").alias("d")).collect()
    assert {(r["node"], r["n"], r["d"]) for r in got} == {(f"n{i}", i + 1, i) for i in range(500)}
    flags = {r["node"]: r["flag"] for r in R.inherited(t, "flag").collect()}
    assert flags == {f"n{i}": i >= 7 for i in range(500)}
    assert {(r["node"], r["depth"]) for r in R.depth_first(t).select("node", "depth").collect()} == {(f"n{i}", i) for i in range(500)}


def test_more_nodes_than_a_recursive_query_takes(spark):
    n = 1_200_000
    t = spark.range(n).select(F.col("id").alias("node"), F.when(F.col("id") > 0, F.floor((F.col("id") - 1) / 1000)).alias("parent"))
    c = R.closure(t)
    assert c.filter("distance = 0").count() == n and c.filter("distance > 0").agg(F.max("distance")).first()[0] == 3


def test_cycles(spark):
    t = tree(spark, [("r", None, 0, False), ("a", "r", 0, True), ("x", "y", 0, False), ("y", "z", 0, True), ("z", "x", 0, False), ("u", "x", 0, False), ("v", "u", 1, False), ("m", "gone", 0, False)])
    got = {(r["node"], r["ancestor"]): r["distance"] for r in R.closure(t).collect()}
    assert {k[1]: d for k, d in got.items() if k[0] == "v"} == {"v": 0, "u": 1, "x": 2, "y": 3, "z": 4}
    assert {k[1]: d for k, d in got.items() if k[0] == "x"} == {"x": 0, "y": 1, "z": 2} and got["a", "r"] == 1 and got["m", "gone"] == 1
    reasons = {}
    for r in R.validity(t).collect():
        reasons.setdefault(r["node"], set()).add(r["reason"])
    assert reasons == {**{k: {"unreachable"} for k in "xyzuv"}, "m": {"missing parent", "unreachable"}}
    assert {r["node"] for r in R.on_cycles(t).collect()} == {"x", "y", "z"}
    assert {r["node"] for r in R.depth_first(t).collect()} == {"r", "a", "m"}
    assert R.closure(t.limit(0)).collect() == [] and R.validity(t.limit(0)).collect() == []


def card(components, model=None, root=None, surface=None):
    head = [{"version": "v0.9", "createSurface": surface}] if surface else []
    update = {"surfaceId": "s", "components": components} | ({"root": root} if root else {})
    return "\n".join(json.dumps(m, ensure_ascii=False) for m in [*head, {"version": "v0.9", "updateComponents": update}, {"version": "v0.9", "updateDataModel": {"surfaceId": "s", "path": "/", "value": model or {}}}])


def cards(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def bound(spark, text, model):
    rows = spark.createDataFrame([(text, json.dumps(model, ensure_ascii=False))], "t string, w string")
    return rows.select(C.bind(F.col("t"), F.col("w")).alias("x")).first()["x"]


# Documents and results that the surveyed behaviour asserts.
MODEL = {"user": {"name": "北京"}, "items": [{"title": "晴"}], "count": 3}


@pytest.mark.parametrize(
    "text,expected",
    [
        ("{{ $__dataModel.user.name }}", "北京"),
        ("{{ '天气：' + $__dataModel.items[0].title + ' ' + $__dataModel.count }}", "天气：晴 3"),
        ("城市 ${/user/name}", "城市 北京"),
        ("{{ 'a + b' + 2.0 + ${/count} + plain }}", "a + b23plain"),
        ("{{ $__dataModel.count > 2 ? 'x' : 'y' }}", "3"),
        ("{{ 'n' + (a ? b : c) }}", ""),
        ("now $__dataModel.count and $__dataModel.items[0].title.", "now 3 and 晴."),
        ('{"path": "/items"}', "晴"),
        ('{"path": "/none"}', ""),
        ('{"call": "formatString", "args": {"value": "n ${/count}"}}', "n 3"),
        ('{"value": "v ${/count}"}', "v 3"),
        ("plain", "plain"),
    ],
)
def test_dynamic_texts(spark, text, expected):
    assert bound(spark, text, MODEL) == expected


def test_required_texts_of_all_kinds(spark):
    weather = [{"id": "a", "component": "Text", "content": "天气"}, {"id": "b", "component": "Text", "content": {"path": "/weather/temp"}},
        {"id": "c", "component": "Text", "content": {"call": "formatString", "args": {"value": "还有 ${/count} 分钟"}}}, {"id": "d", "component": "Text", "content": " "}]
    fields = [{"id": "a", "component": "Extended.Text", "content": "标题"}, {"id": "b", "component": "TextInput", "placeholder": "请输入城市", "text": {"path": "/city"}}, {"id": "c", "component": "Toggle", "label": "专注模式"},
        {"id": "d", "component": "TabContent", "title": "日程"}, {"id": "e", "component": "Select", "options": [{"label": "北京"}, {"title": "上海"}, "三"]}, {"id": "f", "component": "Divider", "label": "no"}]
    rows = C.required_texts(cards(spark, card(weather, {"weather": {"temp": "26°"}, "count": 15}), card(fields, {"city": "深圳"}), "", "no card")).collect()
    found = {i: [r["text"] for r in rows if r["doc_id"] == i] for i in range(4)}
    assert sorted(found[0]) == sorted(["天气", "26°", "还有 15 分钟"])
    assert set(found[1]) == {"标题", "请输入城市", "深圳", "专注模式", "日程", "北京", "上海", "三"}
    assert found[2] == found[3] == []
    assert {r["field"] for r in rows if r["id"] == "e"} == {"options[0].label", "options[1].title", "options[2]"}


def layouts(spark, *texts):
    out = {}
    for r in C.layout(cards(spark, *texts)).collect():
        out.setdefault(r["doc_id"], {})[r["id"]] = (r["x"], r["y"], r["w"], r["h"])
    return out


def test_roots_that_nobody_declares(spark):
    title = {"id": "title", "component": "Text", "content": "25℃", "styles": {"width": 60, "fontSize": 24, "maxLines": 1}}
    column = {"id": "root", "component": "Column", "children": ["title"], "styles": {"width": 160, "height": 160, "padding": 12}}
    got = layouts(spark, card([column, title]), card([{**column, "id": "top"}, title]), card([title, {**column, "id": "top"}], root="top"))
    assert got[0] == {"root": (0, 0, 160, 160), "title": (12, 12, 60, 30)}
    assert set(got[1]) == set(got[2]) == {"top", "title"}


def test_margins_alignment_and_weights(spark):
    def leaf(i, **styles):
        return {"id": i, "component": "Image", "styles": styles}

    row = {"id": "root", "component": "Row", "children": ["a", "b", "c"], "itemMargin": "4vp", "styles": {"padding": {"left": 10, "vertical": 5}, "alignItems": "center"}}
    stack = {"id": "root", "component": "Stack", "children": ["a"], "styles": {"margin": 3}}
    column = {"id": "root", "component": "Column", "children": ["a", "b"], "styles": {"justifyContent": "end", "alignItems": "end"}}
    got = layouts(
        spark,
        card([row, leaf("a", width="25%", height=20), leaf("b", layoutWeight=1, height=10), leaf("c", layoutWeight=3)], surface={"width": 114, "height": 60}),
        card([stack, leaf("a", width=20, height=10, margin={"left": 2, "top": 1})], surface={"width": 100, "height": 50}),
        card([column, leaf("a", width=20, height=10), leaf("b")], surface={"width": 100, "height": 50}),
        card([column, leaf("a", width=20, height=10), {"id": "b", "component": "Column", "children": ["root"]}], root="root"),
    )
    # 104 wide inside, 8 of gaps: 26 for a, 70 shared 1 to 3
    assert got[0] == {"root": (0, 0, 114, 60), "a": (10, 20, 26, 20), "b": (40, 25, 17.5, 10), "c": (61.5, 18, 52.5, 24)}
    assert got[1]["a"] == (42, 21, 18, 9)
    assert got[2] == {"root": (0, 0, 100, 50), "a": (80, 16, 20, 10), "b": (76, 26, 24, 24)}
    assert set(got[3]) == {"root", "a", "b"}  # a component inside itself ends there


def test_deep_cards(spark):
    chain = [{"id": f"n{i}", "component": "Column", "children": [f"n{i + 1}"]} for i in range(12)] + [{"id": "n12", "component": "Text", "content": "x"}]
    assert set(layouts(spark, card(chain))[0]) == {f"n{i}" for i in range(13)}


def test_problems_of_cycles(spark):
    loop = [{"id": "root", "component": "Row", "children": []}, {"id": "a", "component": "Row", "children": ["b"]}, {"id": "b", "component": "Row", "children": ["a"]}]
    got = {(r["doc_id"], r["reason"]) for r in C.problems(cards(spark, card(loop, root="root"), card(loop[:1], root="root"), "nothing")).collect()}
    assert got == {(0, "cycle"), (2, "component lists")}


def test_cards_are_parsed_once(spark):
    """No filter below an explode repeats the parsing; empty cards, unclosed fences and lone backticks stay as they were."""
    body = '{"updateComponents":{"root":"a","components":[{"id":"a","component":"Row","children":["b"]},{"id":"b","component":"Text","content":"x `y` ``z``"}]}}'
    texts = [f"hi `a`\n```genui\n{body}\n```\n```genui\n{{}}\n```", f"```GENUI x\n{body}```", f"﻿{body}\n```genui\n", "```genui\n```", "", None, '{"updateComponents":{"components":[]}}']
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    comps = C.components(C.messages(docs))
    for rows in (comps, C.placed_kinds(comps), C.required_texts(docs), C.edges(comps)):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert not [line for line in plan.splitlines() if "Filter" in line.split("from_json")[0] and "from_json" in line]
    assert {(r.doc_id, r.id) for r in comps.collect()} == {(i, c) for i in (0, 1, 2) for c in "ab"}
    assert {tuple(r) for r in C.placed_kinds(comps).collect()} == {(i, "b", "Text", "a") for i in (0, 1, 2)}
    assert {tuple(r) for r in C.required_texts(docs).collect()} == {(2, "b", "content", "x `y` ``z``"), (0, "b", "content", "x `y` ``z``"), (1, "b", "content", "x `y` ``z``")}


def test_problems_of_odd_lists(spark):
    """Cycles are found in whatever order their components are listed; only documents with a backward place are walked."""
    def card(*comps):
        return json.dumps({"updateComponents": {"root": "r", "components": [{"id": i, "component": "Row", "children": list(k)} for i, k in comps]}})

    cards = [
        card(("r", "a"), ("a", "b"), ("b", "")), card(("b", ""), ("a", "b"), ("r", "a")), card(("r", ""), ("a", "b"), ("b", "a")), card(("r", "r")), card(("r", "ab"), ("a", "b"), ("b", "")),
        card(("r", "a"), ("a", ""), ("a", "")), card(("r", "x")), card(("q", "a"), ("a", "")), card(("r", "aa"), ("a", "")),
    ]
    docs = spark.createDataFrame(list(enumerate(cards)), "doc_id long, text string")
    got = {}
    for r in C.problems(docs).collect():
        got.setdefault(r.doc_id, []).append(r.reason)
    assert {k: sorted(v) for k, v in got.items()} == {2: ["cycle"], 3: ["cycle"], 4: ["several parents"], 5: ["duplicate id"], 6: ["unknown child"], 7: ["no root"]}
    comps = spark.createDataFrame([(0, 0, "r", ["a"]), (0, 1, "a", [])], "doc_id long, ord int, id string, children array<string>")
    assert C.backward(C.placements(comps)).count() == 0
