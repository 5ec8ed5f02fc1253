"""Each heuristic code once where it must fire and once where it must not."""

from test_trees_cards import card, cards

from cardlens.operators.heuristics import crowding, heuristics


def text(i, **styles):
    return {"id": i, "component": "Text", "content": f"text {i}", "styles": styles}


def nest(n, **styles):
    return [{"id": f"b{i}", "component": "Column", "children": [f"b{i + 1}"], "styles": styles} for i in range(n)] + [text(f"b{n}")]


def root(children, *more, **styles):
    return [{"id": "root", "component": "Column", "children": children, "styles": styles}, *more]


def gradient(i, stops, **styles):
    return {"id": i, "component": "Row", "styles": {"linearGradient": {"colors": [["#FF0000", k / stops] for k in range(stops)]}, **styles}}


def button(i, color=None, size=16):
    return {"id": i, "component": "Button", "label": f"go {i}", "styles": {"fontSize": size} | ({"backgroundColor": color} if color else {})}


RED, GREEN, BLUE = "#FF0000", "#00FF00", "#0000FF"
CASES = [
    (root(["a", "b"], gradient("a", 2), gradient("b", 2)), {"COLOR_GRADIENT_OVERCOMPLEX"}),
    (root(["a"], gradient("a", 4)), {"COLOR_GRADIENT_OVERCOMPLEX"}),
    (root(["a", "b"], gradient("a", 3), gradient("b", 2, visibility="hidden")), set()),
    (nest(4, backgroundColor="#80FFFFFF"), {"COLOR_ALPHA_STACK_COMPLEX", "STYLE_SURFACE_NESTING_EXCESSIVE"}),
    (nest(3, backgroundColor="#FFFFFF"), set()),
    (root([*"abcd"], *[gradient(i, 0, backgroundColor=RED) | {"styles": {"backgroundColor": RED}} for i in "abcd"]), {"COLOR_ACCENT_OVERUSED"}),
    (root([*"abc"], *[{"id": i, "component": "Row", "styles": {"backgroundColor": RED}} for i in "abc"]), set()),
    (root([*"abct"], button("a", RED, 12), button("b", GREEN, 11), button("c", BLUE, 12), text("t", fontSize=40)), {"COLOR_ROLE_INCONSISTENT"}),
    (root([*"abc"], text("a"), text("b"), text("c")), {"HIERARCHY_NO_PRIMARY", "HIERARCHY_TOO_MANY_PRIMARY"}),
    (root([*"abc"], text("a", fontSize=30), text("b", fontSize=12), text("c", fontSize=12, fontWeight="bold")), set()),
    (root([*"ab"], text("a", fontSize=12), button("b", size=20)), {"HIERARCHY_ACTION_OVER_PRIMARY"}),
    (root([*"ab"], text("a", fontSize=20), button("b", size=16)), set()),
]


def test_heuristics(spark):
    docs = cards(spark, *[card(c) for c, _ in CASES], "no card")
    found = {}
    for r in heuristics(docs).collect():
        found.setdefault(r["doc_id"], set()).add(r["code"])
    assert {i: found.get(i, set()) for i in range(len(CASES))} == {i: codes for i, (_, codes) in enumerate(CASES)}
    assert len(CASES) not in found


PILL = {"backgroundColor": "#EEEEEE", "borderRadius": 4, "width": 40, "height": 20}
TEN = [text(i) for i in "abcdefghij"]
CROWDS = [
    (root(["a"], text("a", **PILL)), {"AFFORDANCE_FALSE_POSITIVE": 1}),
    (root(["a"], text("a", **PILL) | {"onClick": ["go"]}), {}),
    ([{"id": "root", "component": "Column", "children": ["a"], "onClick": ["go"]}, text("a", **PILL)], {}),
    (root(["a"], text("a", **PILL | {"visibility": "none"})), {}),
    (root(["a"], text("a", **PILL | {"borderRadius": 0})), {}),
    (root(["a"], text("a", **PILL | {"width": "100%"})), {}),
    (root(["a"], text("a", **PILL) | {"content": ""}), {}),
    (root([*"abcdefghij", "k"], *TEN, text("k"), width=160, height=320), {"LAYOUT_DENSITY_HIGH": 11}),
    (root([*"abcdefghij"], *TEN, width=160, height=320), {}),
    (root([*"abcdefghij", "k"], *TEN, text("k", visibility="hidden"), width=160, height=320), {}),
    (root([*"abcdefghij", "k"], *TEN, text("k"), width=181, height=181), {}),
    (root([*"abcdefghij", "k"], *TEN, text("k"), width="matchParent"), {}),
    (root([*"abcdefghij", "k"], *TEN, {"id": "k", "component": "Image", "styles": {"width": 300, "height": 8}}, width="matchParent"), {"LAYOUT_DENSITY_HIGH": 11}),
    (root([*"abcdefghij", "k"], *TEN, {"id": "k", "component": "Image", "styles": {"width": 300, "height": 7}}), {}),
]


def test_crowding(spark):
    found = {}
    for r in crowding(cards(spark, *[card(c) for c, _ in CROWDS], "no card")).collect():
        found.setdefault(r["doc_id"], {})[r["code"]] = r["actual"]
    assert {i: found.get(i, {}) for i in range(len(CROWDS))} == {i: codes for i, (_, codes) in enumerate(CROWDS)}
