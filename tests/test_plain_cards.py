"""Rules on a plain card in its own row say what the tables of ``cards`` say of it."""

import json
import random

import pytest

from cardlens.operators import cards as C
from cardlens.operators import heuristics as H
from cardlens.operators import plain_cards as P
from cardlens.operators.plain import Odd
from cardlens.plans.registry import QUERIES

RUNS = [
    (P.diagnostics, C.diagnostics),
    (P.problems, C.problems),
    (P.text_icon_verdicts, C.text_icon_verdicts),
    (P.statuses, lambda docs: C.statuses(docs, C.diagnostics(docs), C.problems(docs))),
    (P.card_heuristics, H.heuristics),
    (P.card_crowding, H.crowding),
    (P.card_layout, C.layout),
]
TEXTS = ["word", "two  words", "25℃", "标题 text", "·", "", " ", 7, "at ${/a}", "${/b/c} and ${/none}", "{{ $__dataModel.b.c }}", None]
MODELS = [[], [("/", {"a": "x", "b": {"c": 12}})], [("/b", {"c": True})], [(None, {"a": "y"})]]


def some(rng, **most):
    return {k: rng.choice(v) for k, v in most.items() if rng.random() < 0.6}


def some_card(rng, strays=False):
    n = rng.randint(1, 14)
    comps = []
    for i in range(n):
        kind = rng.choice(["Row", "Column", "Text", "Text", "Checkbox", "Image", "Button", "Stack"])
        c = {"id": f"c{i}" if i else "root", "component": kind} | some(rng, itemMargin=[0, 1, 3, "4vp", "5", "x"], onClick=[[], ["open"]])
        c |= {k: v for k, v in some(rng, content=TEXTS, label=TEXTS, text=TEXTS).items() if v is not None}
        c["styles"] = some(rng, width=[10, "16", 20, "60vp", "50%"], height=[12, "30"], padding=[4, "5", {"top": 2}], borderRadius=[0, 4, "8", 12, 16], backgroundColor=["#FFFFFF", "#123456", "red"],
            fontColor=["#777777", "#EEEEEE", "#80112233"], fontSize=[9, 12, "18", 24, "30fp"], fontWeight=[400, 700, "700", "bold"], itemMargin=[2, "7"], visibility=["visible", "visible", "hidden"],
            margin=[2, {"left": 3, "all": "1"}], layoutWeight=[0, 1, 2], justifyContent=["start", "center", "end"], alignItems=["start", "center", "end"])
        comps.append(c)
    for i in range(1, n):  # each under one that comes before it
        comps[rng.randrange(i)].setdefault("children", []).append(f"c{i}")
    if strays:
        comps[-1].setdefault("children", []).append("nobody")  # no cycles: they take the tables long
        comps[-1]["id"] = rng.choice([comps[-1]["id"], "twice"])
        comps.append({"id": rng.choice(["twice", "other"]), "component": "Text"})
    update = {"updateComponents": {"root": rng.choice(["root", "root", "top"]), "components": comps}}
    lines = [{"createSurface": {"surfaceId": "s", "width": 160, "height": 160}}, *[update] * rng.choice([1, 1, 1, 2, 0] if strays else [1])]
    return "\n".join(json.dumps(x, ensure_ascii=False) for x in lines + [{"updateDataModel": {"value": v} | ({} if p is None else {"path": p})} for p, v in rng.choice(MODELS)])


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(5)
    texts = [some_card(rng) for _ in range(100)] + [some_card(rng, True) for _ in range(20)]
    assert sum(is_plain(t) for t in texts[:100]) == 100 and all(list(P.reasons(P.Card(t))) is not None for t in texts)
    odd = ['{"updateComponents":{"components":[{"id":"a","component":"Text","content":{"path":"/a"},"styles":{"width":"5","fontSize":"20"}}]}}\n{"updateDataModel":{"value":{"a":"a long text"}}}', "{broken"]
    pill = {"id": "root", "component": "Text", "content": "tag", "styles": {"width": 40, "height": 20, "borderRadius": 4, "backgroundColor": "#DDEEFF"}}
    odd.append(json.dumps({"updateComponents": {"root": "root", "components": [pill]}}))
    return spark.createDataFrame([*enumerate(texts + odd), (900, None), (901, ""), (902, "no card")], "doc_id long, text string")


def is_plain(body):
    try:
        return bool(list(P.status(body)))
    except Odd:
        return False


def rows(df):
    key = lambda v: round(v, 6) + 0.0 if isinstance(v, float) else v  # noqa: E731 (sums in another order)
    return sorted((tuple(map(key, r)) for r in df.select(sorted(df.columns)).collect()), key=repr)


@pytest.mark.parametrize("run", range(len(RUNS)))
def test_as_the_tables_say(docs, run):
    ours, tables = RUNS[run]
    got = rows(ours(docs))
    assert got and got == rows(tables(docs))


@pytest.mark.parametrize("links,want", [
    ({"root": "a", "a": "b", "b": ""}, []), ({"root": "a", "a": "a"}, ["cycle", "several parents"]), ({"root": "", "a": "b", "b": "a"}, ["cycle"]), ({"root": "aa", "a": ""}, []),
    ({"root": "ab", "a": "b", "b": ""}, ["several parents"]), ({"root": "x"}, ["unknown child"]), ({"a": ""}, ["no root"]),
])
def test_reasons_of_cards_that_are_no_trees(links, want):
    comps = [{"id": i, "component": "Row", "children": list(kids)} for i, kids in links.items()]
    if "aa" in links.values():
        comps[0]["children"] = ["a", "a"]
    card = json.dumps({"updateComponents": {"root": "root", "components": comps}})
    assert sorted(r for r, in P.reasons(P.Card(card))) == want


def test_queries_shuffle_no_components(spark):
    for name in ("validator_status", "card_diagnostics", "card_problems", "assessment_verdicts", "card_heuristics", "card_crowding", "card_layout"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan, name
