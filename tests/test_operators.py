"""The engine's operators on small inputs with known results."""

import json

import pytest
from pyspark.sql import functions as F

from cardlens.functions import scalars as S
from cardlens.operators import cards as C
from cardlens.operators import fusion as U
from cardlens.operators import geometry as G
from cardlens.operators import text as T
from cardlens.operators import tree as R
from cardlens.plans import text as X
from cardlens.sources.cards import read_documents, read_prompts
from cardlens.streaming import harvest as H


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def boxes(spark, rows):
    """rows: (doc, ord, x, y, w, h, kind[, fs[, radius[, contrast]]])"""
    full = [(*r[:2], *map(float, r[2:6]), r[6], *(list(r[7:]) + [16.0, 0.0, 4.5][len(r) - 7 :])) for r in rows]
    return spark.createDataFrame(full, "doc_id long, ord long, x double, y double, w double, h double, kind string, fs double, radius double, contrast double")


def test_scores(spark):
    assert one(spark, S.gaussian_score(F.lit(0.42), 0.42, 0.1)) == 100.0 and one(spark, S.gaussian_score(F.lit(0.62), 0.42, 0.1)) < 20
    assert one(spark, S.clamp(F.lit(float("nan")))) == 0.0 and one(spark, S.clamp(F.lit(float("inf")))) == 0.0 and one(spark, S.clamp(F.lit(None).cast("double"))) is None
    assert one(spark, S.sigmoid_score(F.lit(-1e9), 3.5, 1.0)) == 0.0
    assert [one(spark, S.calibrate(F.lit(x))) for x in (62.5, -50.0, 200.0)] == [64.0, 0.0, 100.0]
    assert [one(spark, S.grade(F.lit(x))) for x in (95.0, 94.9, 85.0, 60.0, 59.0)] == ["S", "A+", "A", "C", "D"]


def test_texts(spark):
    assert one(spark, T.similarity(F.lit("还有 15 分钟"), F.lit("还有15分钟"))) == 1.0
    assert one(spark, S.pointer_get(F.lit('{"a":{"b":[1,{"c":"x"}]}}'), "/a/b/1/c")) == "x"
    assert [one(spark, T.normalize_number(F.lit(x))) for x in ("25.50", "7.0", "+3", "-0", "007", "10")] == ["25.5", "7", "3", "0", "7", "10"]
    required = spark.createDataFrame([(1, 1, "25℃"), (1, 2, "相册"), (1, 3, "26 元"), (1, 4, "30")], "key long, id long, text string")
    seen = spark.createDataFrame([(1, 1, "25"), (1, 2, "相册缓存")], "key long, ord long, text string")
    got = {r["id"]: (r["status"], r["score"]) for r in T.slot_coverage(required, seen).collect()}
    assert got == {1: ("weak_pass", 0.75), 2: ("pass", 1.0), 3: ("missing", 0.0), 4: ("missing", 0.0)}
    assert one(spark, T.scene_of(F.lit("Case-600-30-pet-feeder-020"))) == "30-pet-feeder"
    assert [one(spark, S.safe_name(F.lit(x))) for x in ("a b/c", "...", "_x_")] == ["a_b_c", "item", "x"]
    assert one(spark, T.extract_url(F.lit('I tag: {"result":"https:\\/\\/h.test\\/a.md?x=1"}'))) == "https://h.test/a.md?x=1"


def test_repairs(spark):
    a, b = '{"version":"v0.9","createSurface":{"id":"s"}}', '{"version":"v0.9","updateComponents":{"root":"r","components":[{"id":"r"'
    rows = [(1, f"```genui\n{a}\n{b}\n```"), (2, f"[{a},{a}]"), (3, "no json"), (4, None), (5, f"noise {a} {a.replace(':', ': ')}")]
    got = {}
    for r in T.repair_records(spark.createDataFrame(rows, "id long, text string")).orderBy("id", "n").collect():
        got.setdefault(r["id"], []).append(json.loads(r["record"]))
    assert sorted(got) == [1, 2, 5] and got[2] == got[5] == [json.loads(a)]
    assert got[1] == [json.loads(a), json.loads(b + "}]}}")]
    assert T.balance('{"a":[1,"x') == '{"a":[1,"x"]}' and T.balance("[1}]") == "[1]"


def test_geometry(spark):
    two = boxes(spark, [(1, 1, 10, 10, 50, 20, "text"), (1, 2, 49, 10, 50, 20, "button"), (2, 1, 0, 0, 10, 10, "text")])
    iou = 11 * 20 / (1000 + 1000 - 220)
    assert G.iou_pairs(two).first()["iou"] == pytest.approx(iou)
    scores = {r["doc_id"]: r for r in G.overlap_scores(two, factor=100.0).collect()}
    assert scores[1]["score"] == pytest.approx(100 - 100 * iou) and scores[2]["score"] is None and scores[1]["magnitude"] == pytest.approx(iou / 0.25)
    assert [r["severity"] for r in G.layout_overlap_deductions(two).collect()] == ["medium"]
    area = {r["doc_id"]: r["area"] for r in G.union_area(two).collect()}
    assert area == {1: 1780.0, 2: 100.0}
    moved = two.withColumn("x", F.col("x") + 7).withColumn("y", F.col("y") + 3)
    assert {r["doc_id"]: r["area"] for r in G.union_area(moved).collect()} == area  # translation changes nothing
    lines = G.merge_text_blocks(boxes(spark, [(1, 1, 0, 0, 10, 10, "text"), (1, 2, 14, 1, 10, 10, "text"), (1, 3, 0, 40, 10, 10, "text")])).collect()
    assert sorted((r["x"], r["y"], r["w"], r["h"]) for r in lines) == [(0, 0, 24, 11), (0, 40, 10, 10)]
    kept = G.suppress_overlaps(boxes(spark, [(1, 1, 0, 0, 10, 10, "a"), (1, 2, 0, 0, 10, 9, "a"), (1, 3, 50, 50, 2, 2, "a")])).collect()
    assert sorted(r["ord"] for r in kept) == [1, 3]
    assert G.gap_scores(boxes(spark, [(1, 1, 0, 0, 5, 5, "a"), (1, 2, 0, 9, 5, 5, "a")])).first()["score"] is None


def test_dimensions_and_caps(spark):
    schema = "doc_id long, dimension string, ord long, score double, weight double, confidence double, status string"
    metrics = spark.createDataFrame([(1, d, i, 80.0, 2.0, 1.0, "ok") for i, d in enumerate(["geometry", "information", "layout", "visual"])] + [(1, "geometry", 9, None, 5.0, 0.0, "error")], schema)
    assert {r["dimension"]: r["score"] for r in U.dimension_scores(metrics).collect()} == {"geometry": 80, "information": 80, "layout": 80, "visual": 80, "consistency": 0}
    assert U.overall_scores(metrics).first()["overall"] == 76.0 and U.confidence(metrics).first()["confidence"] == 0.92
    schema = "doc_id long, ord long, code string, severity string, delta double, evidence string, magnitude double, hint string"
    iou = 220 / 1780
    rows = [(1, 1, "layout.overlap", "medium", -12.0, "e", iou / 0.25, "h"), (1, 2, "layout.overlap", "medium", -3.0, "e", 1.0, "x"), (1, 3, "visual.low_contrast", "low", -2.0, "f", None, ""), (1, 4, "geometry.overlap", "low", -9.0, "g", 1.0, "h")]
    caps = U.hard_caps(spark.createDataFrame(rows, schema)).first()
    assert (caps["cap"], caps["codes"], caps["effective"]) == (66.0, 2, 64.0)
    assert U.merge_deductions(spark.createDataFrame(rows, schema)).count() == 3
    assert [r["hint"] for r in U.suggestions(spark.createDataFrame(rows, schema)).collect()] == ["h"]
    assert U.merge_deductions(spark.createDataFrame([], schema)).count() == 0


def test_trees(spark):
    tree = spark.createDataFrame([("a", None, 0, True), ("b", "a", 1, False), ("c", "b", 0, False), ("d", "x", 0, False), ("e", "f", 0, False), ("f", "e", 0, False)], "node string, parent string, pos long, hidden boolean")
    assert {r["node"] for r in R.inherited(tree, "hidden").filter("hidden").collect()} == {"a", "b", "c"}
    found = {(r["node"], r["reason"]) for r in R.validity(tree).collect()}
    assert found == {("d", "missing parent"), ("d", "unreachable"), ("e", "unreachable"), ("f", "unreachable")}


CARD = [
    {"version": "v0.9", "createSurface": {"surfaceId": "s", "width": 146, "height": 146}},
    {"version": "v0.9", "updateDataModel": {"path": "/weather", "value": {"temp": "26°", "items": [{"title": "晴"}]}}},
    {"version": "v0.9", "updateComponents": {"root": "root", "components": [
        {"id": "root", "component": "Row", "children": ["box", "t", "p", "q"], "itemMargin": 4, "styles": {"width": 146, "height": 40}},
        {"id": "box", "component": "Checkbox", "styles": {"width": 16, "height": 16}},
        {"id": "t", "component": "Text", "content": "天气", "styles": {"fontSize": 14}},
        {"id": "p", "component": "Text", "content": {"path": "/weather/temp"}, "styles": {"fontSize": 14}},
        {"id": "q", "component": "Extended.Text", "content": "{{ $__dataModel.weather.items[0].title }}", "styles": {}},
    ]}},
]


@pytest.mark.parametrize("encoding", ["array", "lines", "fenced"])
def test_cards(spark, tmp_path, encoding):
    text = json.dumps(CARD, ensure_ascii=False) if encoding == "array" else "\n".join(json.dumps(m, ensure_ascii=False) for m in CARD)
    if encoding == "fenced":
        text = f"see\n```genui\n{text}\n```"
    (tmp_path / "card.jsonl").write_text("﻿" + text, encoding="utf-8")
    docs = read_documents(spark, str(tmp_path))
    assert C.complete(docs).first()["complete"] and C.problems(docs).count() == 0
    assert {r["id"]: r["text"] for r in C.required_texts(docs).collect()} == {"t": "天气", "p": "26°", "q": "晴"}
    found = {r["code"]: (r["actual"], r["expected"]) for r in C.diagnostics(docs).filter("id = 'box'").collect()}
    assert found == {"TEXT_ICON_GAP_LOW": (0.0, 4.0)}
    assert C.text_icon_verdicts(docs).first()["verdict"] == "issue"
    at = {r["id"]: (r["x"], r["y"], r["w"]) for r in C.layout(docs).collect()}
    assert at["root"] == (0, 0, 146) and at["box"] == (0, 0, 16) and at["t"][:2] == (20, 0)
    assert C.statuses(docs, C.diagnostics(docs), C.problems(docs)).first()["status"] == "pass_with_warnings"


def test_prompts(spark, tmp_path):
    (tmp_path / "q.jsonl").write_text('{"qid":"a","id":"b","query":"one"}\n\nplain words\n{"id":"c","text":"two"}\n{"id":"d"}\n', encoding="utf-8")
    got = [(r["qid"], r["query"]) for r in read_prompts(spark, str(tmp_path / "q.jsonl")).collect()]
    assert got == [("a", "one"), ("q3", "plain words"), ("c", "two")]


def test_streams(spark, tmp_path):
    rows = [(1, "2024-01-01 00:00:00", "result: https://h.test/a"), (2, "2024-01-01 00:00:05", "https://h.test/a"), (3, "2024-01-01 00:01:00", "none"), (4, "2024-01-01 00:02:00", "https://h.test/b")]
    lines = spark.createDataFrame(rows, "n long, ts string, line string").withColumn("ts", F.to_timestamp("ts"))
    lines.write.parquet(str(tmp_path / "in"))
    stream = H.with_event_time(H.read_stream(spark, str(tmp_path / "in"), lines.schema), "ts", "1 hour")
    H.run_available(H.first_seen(H.harvest_urls(stream), ["url"]), str(tmp_path / "out"))
    assert {r["url"] for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {"https://h.test/a", "https://h.test/b"}
    assert [r["n"] for r in H.sessions(lines.withColumn("k", F.lit(1)), "ts", "k", "30 seconds").orderBy("start").collect()] == [2, 1, 1]


def test_registry(spark):
    from cardlens.plans.registry import ORACLES, QUERIES, flagship

    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) > 70
    assert flagship(spark, "/root/testdata/sf0.001").columns == ["doc_id", "overall", "calibrated", "grade"]


def test_metric_registry(spark):
    from cardlens.operators import metrics as M

    one_card = boxes(spark, [(1, i, 8 + 40 * (i % 3), 8 + 40 * (i // 3), 30, 30, ("text", "image", "button")[i % 3]) for i in range(9)])
    rows = {(r["dimension"], r["name"]): r for r in M.run_metrics(one_card).collect()}
    assert set(rows) == set(M.METRICS) and all(r["score"] is None or 0 <= r["score"] <= 100 for r in rows.values())
    assert rows["geometry", "alignment"]["score"] == 100.0 and rows["geometry", "overlap"]["score"] == 100.0
    assert rows["visual", "sparse_text_stack"]["status"] == "skipped"

    @M.register_metric("geometry", "count", 1)
    def count(b):
        return b.groupBy("doc_id").agg(F.count("*").cast("double").alias("score"))

    try:
        assert M.run_metrics(one_card, [("geometry", "count")]).first()["score"] == 9.0
    finally:
        del M.METRICS["geometry", "count"]


def test_surfaces(spark):
    from cardlens.operators import surfaces as Q

    rows = boxes(spark, [(1, 1, 0, 0, 40, 40, "image", 16.0, 4.0), (1, 2, 10, 10, 10, 10, "text"), (1, 3, 40, 5, 20, 20, "button", 16.0, 4.0), (1, 4, 41, 5, 20, 20, "text")])
    assert {r["ord"]: r["texts"] for r in Q.texts_inside(rows).collect()} == {1: 1, 3: 1}
    assert [r["ord"] for r in Q.without_text_doubles(rows).collect()] == [1]
    assert [(r["a"], r["b"], r["gap"]) for r in Q.touching_pairs(rows).collect()] == [(1, 3, 0.0)]
    assert Q.best_control(rows).first()["ord"] == 3
    assert one(spark, Q.parse_bounds(F.lit("[1,2][30,40]")))["r"] == 30 and one(spark, Q.parse_bounds(F.lit("[1,2][1,4]"))) is None


def test_streams_of_a_hot_user_are_bounded(spark, tmp_path):
    rows = [(i, 7, "click", json.dumps({"k": i % 1500})) for i in range(5000)] + [(6000, 8, "view", '{"k": 1}'), (6001, 8, "view", '{"k":1}')]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string, props string").write.parquet(f"{tmp_path}/events.parquet")
    streams = X._streams(spark.createDataFrame(rows, "event_id long, user_id long, event_type string, props string"), F.lit("{}"), " ")
    assert streams.filter("user_id = 7").count() == 5 and streams.agg(F.max(F.length("s"))).first()[0] < 3000
    assert {tuple(r) for r in X.json_segments(spark, str(tmp_path)).collect()} == {(7, 5000), (8, 2)}
    assert {tuple(r) for r in X.repaired_records(spark, str(tmp_path)).collect()} == {(7, 1500), (8, 1)}


def test_best_match_reads_whole_turns(spark, tmp_path):
    rows = [(1, 0, "user", "Hello.\nhow are you today"), (1, 1, "assistant", "Hello.\nnothing alike at all"), (1, 3, "assistant", "Hullo.\nhow are you today")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    (got,) = X.similarity_best_match(spark, str(tmp_path)).collect()
    assert (got["id"], got["ord"]) == (1000, 3) and 0.9 < got["similarity"] < 1
