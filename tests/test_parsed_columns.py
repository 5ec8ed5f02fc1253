"""Parsing for a rule computes the columns that it reads and no others, and odd texts and styles stay what they were."""

import json

from pyspark.sql import functions as F

from cardlens.functions import scalars as S
from cardlens.operators import cards as C
from cardlens.operators import static as G

STYLES = [{"width": 40, "height": "20vp", "padding": {"top": "4", "left": 2}}, {"width": "wide", "height": None, "margin": "3"}, {"width": 1.5, "height": 1e3, "visibility": "none"}, {}, "words", [1], 7, None]


def cards(spark):
    parts = [{"id": f"n{i}", "component": "Text", "content": "x", "styles": s} for i, s in enumerate(STYLES)] + [{"id": "bare", "component": "Text"}]
    root = {"id": "root", "component": "Column", "children": [p["id"] for p in parts], "styles": {"width": "matchParent", "height": 90}}
    lines = [json.dumps({"createSurface": {"width": 160, "height": 100}}), json.dumps({"updateComponents": {"root": "root", "components": [root, *parts]}})]
    return spark.createDataFrame([(1, "\n".join(lines)), (2, ",\r\n".join(lines) + " , \r\n"), (3, f"[{','.join(lines)}]"), (4, None), (5, "{broken")], "doc_id long, text string")


def test_only_what_is_asked_for(spark):
    docs = cards(spark)
    every, few = G.parsed(docs), G.parsed(docs, G.PLACED)
    assert set(few.columns) == {"doc_id", "id", "parent", "pos", *G.PLACED}
    same = lambda df: sorted(map(repr, df.select(sorted(few.columns)).collect()))
    assert same(every) == same(few)


def test_odd_styles(spark):
    rows = G.parsed(cards(spark), ("w", "eh", "styled", "hidden", "pad")).orderBy("id").collect()
    got = {i: [(r.id, r.w, r.eh, r.styled, r.hidden, r.pad and tuple(r.pad)) for r in rows if r.doc_id == i] for i in range(1, 6)}
    none = (0.0,) * 4
    bare = (None, None, False, False, none)
    want = [("bare", *bare), ("n0", 40.0, 20.0, True, False, (4.0, 0.0, 0.0, 2.0)), ("n1", None, 20.0, True, False, none), ("n2", 1.5, 1000.0, True, True, none), ("n3", None, 20.0, True, False, none)]
    assert got[1] == want + [(f"n{i}", *bare) for i in range(4, 8)] + [("root", 160.0, 90.0, True, False, none)]
    assert got[2] == got[1] and got[3] == got[1] and not got[4] and not got[5]


def test_numbers_without_failing_casts(spark):
    rows = spark.createDataFrame([(" 4vp ",), ("-1.5",), ("",), ("1e3",), ("4%",), ("4 4",), (None,)], "x string")
    out = rows.select(S.number_of(F.col("x"), r"^\s*(-?[0-9]+(?:\.[0-9]+)?)(?:vp)?\s*$").alias("n"), C.number(F.col("x")).alias("m")).collect()
    assert [r.n for r in out] == [r.m for r in out] == [4.0, -1.5, None, None, None, None, None]
