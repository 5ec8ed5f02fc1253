"""Rules on containers and their children: a card that fires and one that doesn't for each."""

import json

import pytest

from cardlens.operators.containers import container_findings


def card(*parts, root="root"):
    top = {"id": root, "component": "Column", "children": [p["id"] for p in parts if not p.pop("inner", False)], "styles": {"width": 300, "height": 300}}
    return "\n".join(json.dumps(m) for m in ({"createSurface": {"width": 300, "height": 300}}, {"updateComponents": {"root": root, "components": [top, *parts]}}))


def part(name, kind, children=(), inner=False, content=None, gap=None, **styles):
    out = {"id": name, "component": kind, "children": list(children), "inner": inner, "styles": styles}
    return out | ({} if content is None else {"content": content}) | ({} if gap is None else {"itemMargin": gap})


def text(name, content="ab", **styles):
    return part(name, "Text", inner=True, content=content, **styles)


def lines(height, ground, n=3, **more):
    paint = {"backgroundColor": "#EEEEEE"} if ground else {}
    return [part("c", "Column", [f"t{i}" for i in range(n)], gap=2, width=90, height=height, **paint, **more), *[text(f"t{i}", fontSize=10) for i in range(n)]]


def surface(padding, align="start", width=100, kind="Column", child="Button", **more):
    return [part("s", kind, ["b"], width=120, borderRadius=8, backgroundColor="#EEEEEE", padding=padding, alignItems=align, **more), part("b", child, inner=True, content="x", width=width)]


def alike(*gaps, last=None):
    rows = []
    for i, g in enumerate(gaps):
        rows += [part(f"r{i}", "Row", [f"x{i}", f"y{i}"], gap=g, width=80, height=20), text(f"x{i}", width=20), text(f"y{i}", width=last if last and i == len(gaps) - 1 else 30)]
    return rows


CASES = [
    (lines(41, True), [("c", "LAYOUT_VERTICAL_DENSITY_HIGH", 7.0, 8.0)]),
    (lines(42, True), []),
    (lines(29, False), [("c", "LAYOUT_VERTICAL_DENSITY_HIGH", -5.0, -4.0)]),
    (lines(30, False), []),
    (lines(20, True, n=2), []),
    (lines(20, True, visibility="none"), []),
    (lines(41, True, padding="{{ p }}"), []),
    (lines(45, True, padding={"top": 4, "left": 50}), [("c", "LAYOUT_VERTICAL_DENSITY_HIGH", 7.0, 8.0)]),
    ([part("c", "Column", ["a", "b"], width=90), text("a", "标 题", fontSize=20, height=18), text("b")], [("a", "TEXT_COLLISION_RISK", 0.0, 4.0)]),
    ([part("c", "Column", ["a", "b"], width=90), text("a", "标1", fontSize=20, height=18), text("b")], [("a", "TEXT_GAP_LOW", 0.0, 4.0)]),
    ([part("c", "Column", ["a", "b"], gap=1, width=90), text("a", "标题", fontSize=20, height=18), text("b", margin={"top": 2})], [("a", "TEXT_GAP_LOW", 3.0, 4.0)]),
    ([part("c", "Column", ["a", "b"], gap=4, width=90), text("a", "标题", fontSize=20, height=18), text("b")], []),
    ([part("c", "Column", ["a", "b"], width=90), text("a", "标题", fontSize=20, height=20), text("b")], []),
    ([part("c", "Column", ["a", "b"], width=90), text("a", "words", fontSize=20, height=18), text("b")], []),
    ([part("c", "Column", ["a", "b", "nobody"], width=90), text("a", "标题", fontSize=20, height=18), text("b")], [("a", "TEXT_COLLISION_RISK", 0.0, 4.0)]),
    (surface([8, 8]), [("s", "SURFACE_CONTENT_EDGE_CLEARANCE_LOW", 0.0, 4.0)]),
    (surface("8"), [("s", "SURFACE_CONTENT_EDGE_CLEARANCE_LOW", 0.0, 4.0)]),
    (surface({"all": 8}), [("s", "SURFACE_CONTENT_EDGE_CLEARANCE_LOW", 0.0, 4.0)]),
    (surface({"left": 8, "right": "5%"}), [("s", "SURFACE_CONTENT_EDGE_CLEARANCE_LOW", 0.0, 4.0)]),
    (surface({"left": 8}), []),
    (surface(0, width=50), []),
    (surface(0, width=120), [("s", "SURFACE_CONTENT_EDGE_CLEARANCE_LOW", 0.0, 4.0)]),
    (surface([8], align="center"), []),
    (surface([8], align="center", width=116), [("s", "SURFACE_CONTENT_EDGE_CLEARANCE_LOW", 2.0, 4.0)]),
    (surface([8], align="end"), [("s", "SURFACE_CONTENT_EDGE_CLEARANCE_LOW", 0.0, 4.0)]),
    (surface([8], align="odd"), []),
    (surface([8], kind="Row"), [("s", "SURFACE_CONTENT_EDGE_CLEARANCE_LOW", 0.0, 4.0)]),
    (surface([8], kind="Row", justifyContent="center"), []),
    (surface([8], child="Image"), []),
    ([text("p", "tag", borderRadius=4, backgroundColor="#111111", padding=[2, 4]) | {"inner": False}], [("p", "SURFACE_CONTENT_EDGE_CLEARANCE_LOW", 0.0, 4.0)]),
    ([text("p", "tag", borderRadius=4, backgroundColor="#111111", padding=4) | {"inner": False}], []),
    ([text("p", "tag", borderRadius=4, backgroundColor="#111111", padding=[4], textAlign="center") | {"inner": False}], []),
    (alike(8, 8, None), [("r2", "LAYOUT_SPACING_MISSING", 0.0, 8.0)]),
    (alike(8, 13, 8), [("r1", "LAYOUT_SPACING_INCONSISTENT", 13.0, 8.0)]),
    (alike(8, 11, 8), []),
    (alike(8, 8), []),
    (alike(0, 0, 8), []),
    (alike(8, 8, 0, 0), []),
    (alike(8, 8, 12, 0), []),
    (alike(8, 8, 0, last=31), []),
]


def test_each_rule_fires_and_stays_silent(spark):
    docs = [(i, card(*[dict(p) for p in parts]), 0) for i, (parts, _) in enumerate(CASES)]
    odd = [(1000, None, 0), (1001, "", 0), (1002, "{broken", 0), (1003, card(), 0)]
    found = container_findings(spark.createDataFrame(docs + odd, "doc_id long, text string, kids int")).collect()
    got = {i: [] for i in range(len(CASES))}
    for r in found:
        got[r.doc_id].append((r.id, r.code, r.actual, r.expected))
    for i, (_, want) in enumerate(CASES):
        assert got[i] == want, i


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_nothing_in_nothing_out(spark, rows):
    assert container_findings(spark.createDataFrame(rows, "doc_id long, text string")).count() == 0
