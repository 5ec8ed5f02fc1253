"""Results that an earlier oracle had wrong, against plain Python."""

import difflib
import json
import random
import re

from pyspark.sql import functions as F

from cardlens.operators import cards as C
from cardlens.operators import fusion as U
from cardlens.operators import text as T


def test_records_are_distinct_by_content(spark):
    texts = ['{"a":1,"b":2}', '{"b": 2, "a":1}', '{"a":"x y"}', '{"a":"xy"}', '{"a":[2,1]}', '{"a":[1,2]}', '{"a":{"d":1,"c":null}}', ' {"a":{"c":null,"d":1}} ', "no json", "no  json", '{"a":1,"b":2}']
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, t string")

    def key(t):
        try:
            return json.dumps(json.loads(t), sort_keys=True)
        except ValueError:
            return t

    expected = {key(t): i for i, t in reversed(list(enumerate(texts)))}
    assert sorted(r["id"] for r in T.distinct_records(rows, "t", "id").collect()) == sorted(expected.values())
    assert T.distinct_records(rows.limit(0), "t", "id").collect() == []


def test_scenes(spark):
    names = ["taskspec_gpt55__Case-600-30-pet-020", "Case-29-elderly-care-008", "x Case-1-a-2", "Case-1-2", "", None, "Case-1-a-2 "]
    expected = {n: (m.group(1) if (m := re.search(r"Case-\d+-(.+?)-\d+$", n or "")) else "unknown") for n in names}
    got = spark.createDataFrame([(n,) for n in names], "n string").select("n", T.scene_of(F.col("n")).alias("s")).collect()
    assert {r["n"]: r["s"] for r in got} == expected


def test_cells_say_what_they_cut(spark):
    rows = spark.createDataFrame([("a", "x" * 32_000), ("b", "y" * 32_001)], "n string, t string")
    got = {r["n"]: r["c"] for r in rows.select("n", T.cell_text(F.col("t"), F.col("n")).alias("c")).collect()}
    assert got == {"a": "x" * 32_000, "b": "y" * 32_000 + "\n... [内容过长已截断，完整见 b]"}


def test_batch_and_card_statuses_reach_every_branch(spark):
    metrics = spark.createDataFrame([(i, "layout", "m", 10.0, 80.0, "ok", 0.5 if i in (3, 5) else 0.9) for i in range(1, 7)], "doc_id long, dimension string, name string, weight double, score double, status string, confidence double")
    deductions = spark.createDataFrame([(1, "high"), (2, "medium"), (5, "medium"), (6, "low")], "doc_id long, severity string")
    got = {r["batch"]: (r["docs"], r["high"], r["medium"], r["unsure"], r["status"]) for r in U.batch_statuses(metrics, deductions, F.col("doc_id")).collect()}
    assert got == {1: (1, 1, 0, 0, "fail"), 2: (1, 0, 1, 0, "pass_with_warnings"), 3: (1, 0, 0, 1, "needs_review"), 4: (1, 0, 0, 0, "pass"), 5: (1, 0, 1, 1, "needs_review"), 6: (1, 0, 0, 0, "pass")}
    docs = spark.createDataFrame([(i,) for i in range(1, 6)], "doc_id long")
    findings = spark.createDataFrame([(1, "error"), (2, "warning"), (4, "warning")], "doc_id long, severity string")
    reasons, verdicts = spark.createDataFrame([(3, "no root")], "doc_id long, reason string"), spark.createDataFrame([(4, "undetermined"), (4, "clear"), (1, "undetermined"), (2, "clear")], "doc_id long, verdict string")
    assert {r["doc_id"]: r["status"] for r in C.statuses(docs, findings, reasons, verdicts).collect()} == {1: "fail", 2: "pass_with_warnings", 3: "fail", 4: "needs_review", 5: "pass"}


def test_slots_of_whole_texts(spark):
    """Numbers and units included, against a plain search."""
    rng = random.Random(11)
    atoms = ["25℃", "26 元", "30", "7.50%", "温度", "cache", "3 min", "12 小时", "°C", "-4", "x"]
    required = [(k, k * 10 + i, " ".join(rng.choice(atoms) for _ in range(rng.randint(1, 3)))) for k in range(6) for i in range(8)]
    seen = [(k, i, " ".join(rng.choice(atoms) for _ in range(rng.randint(1, 4)))) for k in range(5) for i in range(3)] + [(5, 0, "25 rooms")]
    required += [(5, 999, "25℃"), (6, 1000, "today sunny weather forecasts"), (6, 1001, "a text of which one is short")]
    seen += [(6, 1, "today sunny weather forecast5"), (6, 2, "b text of which one is short"), (6, 3, "today sunny whether forecasts are")]
    norm = lambda t: spark.range(1).select(T.S.normalize_text(F.lit(t)).alias("x")).first()["x"]
    everything = {k: norm(" ".join(t for q, _, t in seen if q == k)) for k in range(7)}
    spellings = {s: n for n, all_ in T.UNITS.items() for s in all_ if s != "c"}

    def likeness(a, b):
        if not a or not b:
            return 0.0
        return min(len(a), len(b)) / max(len(a), len(b)) if a in b or b in a else difflib.SequenceMatcher(None, a, b).ratio()

    def number(x):
        x = x.lstrip("+")
        return (x.rstrip("0").rstrip(".") if "." in x else x) or "0"

    def status(k, t):
        all_ = everything.get(k)
        if all_ is None:
            return "missing"
        n = norm(t)
        if len(n) >= 2 and n in all_:
            return "pass"
        if any(likeness(n, norm(s)) >= 0.9 for q, _, s in seen if q == k):
            return "pass"
        numbers = [number(x) for x in re.findall(T.NUMBER, t)]
        units = [spellings.get(u.lower(), u.lower()) for u in re.findall(T.UNIT[4:], t, flags=re.I)]
        if not numbers or not all(norm(x) in all_ for x in numbers):
            return "missing"
        there = all(any(s in all_ for s in T.UNITS.get(u, [u])) for u in units)
        return "numeric_pass" if there else "weak_pass"

    got = {r["id"]: r["status"] for r in T.slot_coverage(spark.createDataFrame(required, "key long, id long, text string"), spark.createDataFrame(seen, "key long, ord long, text string")).collect()}
    assert got == {i: status(k, t) for k, i, t in required} and len(set(got.values())) == 4
    assert got[1000] == got[1001] == "pass"  # neither is contained, both are nearly there


def test_models_are_written_in_order(spark):
    """Random writes at random depths against a plain fold; strings, objects and lists at their own path."""
    rng = random.Random(3)
    paths = ["/", "/a", "/a/b", "/a/b/c", "/d", "/d/0", "/x~1y", "/a/b~0"]
    values = ["new", 5, True, None, "", {"b": "old", "c": {"d": [1, {"e": "deep"}]}}, ["x", ["y", ["z"]]], 'qu"ote', 1.5]

    def put(model, path, value):
        if path == "/":
            return value if isinstance(value, dict) else {"value": value}
        keys = [k.replace("~1", "/").replace("~0", "~") for k in path.strip("/").split("/")]
        at = model
        for k in keys[:-1]:
            at[k] = at[k] if isinstance(at.get(k), dict) else {}
            at = at[k]
        at[keys[-1]] = value
        return model

    docs, want = [], {}
    for i in range(120):
        writes = [(rng.choice(paths), rng.choice(values)) for _ in range(rng.randint(0, 4))]
        lines = [json.dumps({"createSurface": {"surfaceId": "s"}})] + [json.dumps({"updateDataModel": {"path": p, "value": v}}) for p, v in writes]
        docs.append((i, "\n".join(lines)))
        model = {}
        for p, v in writes:
            model = put(model, p, json.loads(json.dumps(v)))
        want[i] = model
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: json.loads(r["model"]) for r in C.data_model(C.messages(table)).collect()}
    assert got == want


def test_bound_strings_and_deep_values_are_shown(spark):
    def card(*writes):
        texts = [{"id": f"t{i}", "component": "Text", "content": {"path": p}} for i, p in enumerate(["/a/b", "/a", "/list"])]
        root = {"id": "root", "component": "Column", "children": ["t0", "t1", "t2"]}
        rows = [{"createSurface": {"surfaceId": "s"}}, {"updateComponents": {"root": "root", "components": [root, *texts]}}]
        return "\n".join(json.dumps(x, ensure_ascii=False) for x in rows + [{"updateDataModel": {"path": p, "value": v}} for p, v in writes])

    docs = spark.createDataFrame([(1, card(("/a", {"b": "old"}), ("/a/b", "new"))), (2, card(("/list", ["x", ["y", {"k": ["z", 1]}]]), ("/a", {"b": "b", "c": {"d": "d"}})))], "doc_id long, text string")
    got = {(r["doc_id"], r["id"]): r["text"] for r in C.required_texts(docs).collect()}
    assert got == {(1, "t0"): "new", (1, "t1"): "new", (2, "t0"): "b", (2, "t1"): "b d", (2, "t2"): "x y z 1"}


def test_hidden_components_have_no_findings(spark):
    def card(hidden):
        styles = {"width": 10, "fontSize": 20, "fontColor": "#777777"}
        text = {"id": "t", "component": "Text", "content": "a long text that is cut", "styles": styles}
        box = {"id": "box", "component": "Column", "children": ["t"], "styles": {"backgroundColor": "#888888"} | ({"visibility": "hidden"} if hidden else {})}
        return "\n".join(json.dumps(x) for x in [{"createSurface": {"surfaceId": "s"}}, {"updateComponents": {"root": "root", "components": [{"id": "root", "component": "Column", "children": ["box"]}, box, text]}}])

    got = C.diagnostics(spark.createDataFrame([(1, card(False)), (2, card(True))], "doc_id long, text string")).collect()
    assert {r["code"] for r in got if r["doc_id"] == 1} == {"TEXT_CLIP_RISK", "COLOR_CONTRAST_LOW"} and not [r for r in got if r["doc_id"] == 2]
