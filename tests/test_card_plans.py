"""Rules on cards read what they need once, and findings are right where something isn't said."""

from pyspark.sql import functions as F
from test_trees_cards import card, cards

from cardlens.functions import scalars as S
from cardlens.operators import cards as C
from cardlens.operators import metrics as M
from cardlens.operators import text as T
from cardlens.operators.heuristics import visible_components


def reads(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def note(i, **styles):
    return {"id": i, "component": "Text", "content": "some words", "styles": {"width": 80, "fontSize": 12, **styles}}


def test_diagnostics_read_components_three_times(spark):
    root = {"id": "root", "component": "Column", "children": ["a", "b"], "styles": {"backgroundColor": "#FFFFFF"}}
    docs = cards(spark, card([root, note("a", fontColor="#EEEEEE"), note("b")]))
    found = C.diagnostics(docs)
    assert reads(found) == 4  # children under their parents (two sides), components, documents
    low = [(r.id, r.severity) for r in found.collect() if r.code == "COLOR_CONTRAST_LOW"]
    assert low == [("a", "error")]  # b says nothing of its colour, so nothing can be told of its contrast


def test_hidden_parts_and_overflow_in_one_pass(spark):
    row = {"id": "r", "component": "Row", "children": ["a", "b", "h"], "itemMargin": 3, "styles": {"width": 100}}
    hidden = note("h", visibility="hidden")
    docs = cards(spark, card([{"id": "root", "component": "Column", "children": ["r"]}, row, note("a"), note("b"), hidden]))
    got = sorted((r.id, r.code, r.actual) for r in C.diagnostics(docs).collect())
    assert got == [("r", "LAYOUT_BOUNDS_OVERFLOW", 63.0), ("r", "LAYOUT_SPACING_NON_TOKEN", 3.0)]


def test_colours_from_one_number(spark):
    rows = spark.createDataFrame([("#FF8000",), ("#80FF8000",), ("#ff80",), ("red",), (None,)], "c string")
    got = [r.c and tuple(round(v * 255) for v in r.c) for r in rows.select(S.parse_color(F.col("c")).alias("c")).collect()]
    assert got == [(255, 128, 0, 255), (255, 128, 0, 128), None, None, None]


def test_sides_of_boxes(spark):
    rows = spark.createDataFrame([("8",), (" 4vp ",), ('{"top":"4","horizontal":2,"all":1}',), ("[8,8]",), ("wide",), (None,)], "v string")
    sides = [list(r[0]) for r in rows.select(C.box_edges(F.col("v"))).collect()]
    assert sides == [[8.0] * 4, [4.0] * 4, [4.0, 2.0, 1.0, 2.0], [0.0] * 4, [0.0] * 4, [0.0] * 4]


def test_heuristics_have_no_sort_and_no_rows_of_units(spark):
    root = {"id": "root", "component": "Column", "children": ["a", "b"]}
    found = visible_components(cards(spark, card([root, note("a"), note("b")])))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "unit" not in found.columns and reads(found) == 2
    assert sorted((r.id, r.placed) for r in found.collect()) == [("a", True), ("b", True), ("root", False)]


def test_a_frame_is_made_once_for_all_its_metrics(spark):
    made = []

    def frame(boxes):
        made.append(1)
        return boxes.groupBy("doc_id").agg(F.sum("x").alias("a"), F.max("x").alias("b"))

    before = dict(M.METRICS)
    try:
        for name, column in (("one", "a"), ("two", "b")):
            M.register_metric("test", name, 1)(M._of(frame, column))
        M.register_metric("test", "three", 1)(lambda b: b.groupBy("doc_id").agg(F.min("x").alias("score")))
        boxes = spark.createDataFrame([(1, 2.0), (1, 3.0)], "doc_id long, x double")
        rows = M.run_metrics(boxes, [("test", "one"), ("test", "two"), ("test", "three")]).collect()
    finally:
        M.METRICS.clear()
        M.METRICS.update(before)
    assert len(made) == 1 and {r["name"]: r.score for r in rows} == {"one": 5.0, "two": 3.0, "three": 2.0}


def test_pairs_of_texts_that_can_reach_a_similarity(spark):
    texts = [("", ""), ("abcdefghij" * 2, "abcdefghij" * 2 + "xx"), ("abc", "zzz"), ("a" * 11 + "b" * 9, "a" * 11 + "c" * 9), ("a" * 9 + "b", "a" * 9 + "c")]
    rows = spark.createDataFrame(texts, "a string, b string").select("a", "b", T.likeness(F.col("a"), F.col("b")).alias("s"), *[T.may_reach(T.sized(F.col("a")), T.sized(F.col("b")), x).alias(n) for n, x in (("partly", 0.55), ("same", 0.9))])
    got = [(r.s, r.partly, r.same) for r in rows.collect()]
    assert [x[0] for x in got] == [0.0, 20 / 22, 0.0, 0.55, 0.9]
    assert [x[1] for x in got] == [False, True, False, True, True] and [x[2] for x in got] == [False, True, False, False, True]


def test_empty_texts_have_no_best_match(spark):
    required, seen = spark.createDataFrame([(1, 1, ".")], "key long, id long, text string"), spark.createDataFrame([(1, 1, "")], "key long, ord long, text string")
    assert [tuple(r) for r in T.best_match(required, seen).collect()] == [(1, None, 0.0)]


def test_every_metric_of_boxes_runs_for_every_card(spark):
    from cardlens.plans.registry import ORACLES

    assert all(f"'{d}' AS dimension, '{n}' AS name" in ORACLES["metric_results"] for d, n in M.METRICS)
    box = "doc_id long, ord long, x double, y double, w double, h double, kind string, fs double, radius double, contrast double"
    rows = M.run_metrics(spark.createDataFrame([(1, 1, 8.0, 8.0, 30.0, 30.0, "image", 12.0, 4.0, 4.5)], box)).collect()
    assert {(r.dimension, r["name"]) for r in rows} == set(M.METRICS) and len(rows) == len(M.METRICS)
    assert {r.score for r in rows if r["name"] in ("reading_flow", "hierarchy")} == {0.0}  # no text: they count, and score 0
