"""Plain cards in their own row say what the tables of ``static`` say of them; other cards are told from them."""

import json
import random

import pytest
from test_static import beside_card, deep_card, near_card, some_card

from cardlens.operators import plain as P
from cardlens.operators import static as G
from cardlens.plans.registry import QUERIES

RUNS = [
    (P.static_layout, P.boxes, lambda docs: G.static_layout(docs)),
    (P.text_surface_overlaps, P.text_surfaces, lambda docs: G.text_surface_overlaps(G._boxed(labels(docs), G.boxes_of(G.parsed(docs))))),
    (P.stack_text_image_overlaps, P.stack_overlaps, lambda docs: G.stack_overlaps(labels(docs))[0]),
    (P.stack_verdicts, P.stack_verdict, lambda docs: G.stack_verdicts(docs, *G.stack_overlaps(labels(docs)))),
    (P.text_contrasts, P.contrasts, lambda docs: G.contrasts(labels(docs))),
]


def labels(docs):
    return G.labelled(G.parsed(docs))


def text(comps, root="root", joint="\n"):
    head = {"createSurface": {"surfaceId": "s", "width": 160, "height": 160}}
    return joint.join(json.dumps(x) for x in (head, {"updateComponents": {"root": root, "components": comps}}, {"updateDataModel": {"path": "/", "value": {"t": "text", "p": 3}}}))


def part(i, kind="Text", **more):
    return {"id": i, "component": kind, **more}


TOP = part("root", "Column", children=["a", "b"], styles={"width": 160, "height": 90})
#: Cards that aren't plain, each for one reason.
ODD = {
    "twice": text([TOP, part("a"), part("a")]), "two parents": text([TOP, part("a", "Row", children=["b"]), part("b")]), "cycle": text([TOP, part("x", "Row", children=["y"]), part("y", "Row", children=["x"])]),
    "null": text([TOP, part("a", styles={"width": None})]), "bound": text([TOP, part("a", content="{{ 'a' + ${/t} }}")]), "number": text([TOP, part(5)]), "styles": text([TOP, part("a", styles="words")]),
    "key twice": text([TOP]).replace('"width": 160', '"width": 160, "width": 90'), "broken": text([TOP])[:-1] + "\n{broken", "long": text([TOP, *[part(f"n{i}") for i in range(P.MOST_PARTS)]]),
    "surrogate": text([TOP, part("a\ud800")]), "infinite": text([TOP, part("a", styles={"width": float("inf")})]),
}


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(77)
    plain = [c for c in (some_card(rng) for _ in range(700)) if is_plain(text(c))][:120]
    more = [deep_card(40), *[near_card(g) for g in range(4)], *[beside_card(m) for m in (30, 40)]]
    texts = [text(c) for c in plain + more] + [text(c, joint=",\r\n") for c in more] + [f"```genui\n{text(c)}\n```" for c in more] + [f"[{text(c, joint=',')}]" for c in more]
    assert len(plain) == 120 and all(map(is_plain, texts[: len(plain) + len(more)]))
    return spark.createDataFrame([*enumerate(texts), (900, None), (901, ""), (902, "no card")], "doc_id long, text string")


def is_plain(body):
    try:
        card = P.parts(body)
        for _, of, _ in RUNS:
            list(of(card))
        return True
    except P.Odd:
        return False


def rows(df):
    key = lambda v: round(v, 6) + 0.0 if isinstance(v, float) else v
    return sorted((tuple(map(key, r)) for r in df.select(sorted(df.columns)).collect()), key=repr)


@pytest.mark.parametrize("run", range(len(RUNS)))
def test_as_the_tables_say(docs, run):
    ours, _, tables = RUNS[run]
    got = rows(ours(docs))
    assert got and got == rows(tables(docs))


@pytest.mark.parametrize("why", ODD)
def test_odd_cards_are_told(why):
    assert not is_plain(ODD[why])


def test_odd_cards_go_through_the_tables(spark):
    docs = spark.createDataFrame([(1, ODD["bound"]), (2, ODD["two parents"]), (3, text([TOP, part("a", styles={"width": 30, "height": 9}), part("b")]))], "doc_id long, text string")
    assert rows(P.static_layout(docs)) == rows(G.static_layout(docs)) and rows(P.stack_verdicts(docs)) == rows(RUNS[3][2](docs))


def test_static_queries_shuffle_no_components(spark):
    """All that is written is the result: no table of components, no rounds."""
    for name in ("static_boxes", "stack_text_image_overlap", "stack_overlap_verdicts", "text_surface_overlap", "contrast_states"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan, name
