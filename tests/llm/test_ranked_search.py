"""Ranked search against a full sort of brute-force scores."""

import math
import random
import re
from collections import Counter

import numpy as np

from cardlens.llm import ranked_search as R

SCHEMA = "doc_id long, text string, rank string, score string, query string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(rows, items, k):
    docs = [(i, Counter(terms(t)), len(terms(t))) for i, t in rows if terms(t)]
    n_docs, total = len(docs), sum(n for _, _, n in docs)
    df = Counter(w for _, tf, _ in docs for w in tf)
    out = []
    for item, text in items:
        scored = []
        for i, tf, n in docs:
            m = 75 + 25 * n * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * tf[w] // (1000 * tf[w] + 12 * m)) for w in terms(text) if w in tf)
            if s > 0:
                scored.append((-s, math.inf if i is None else i))
        for r, (s, i) in enumerate(sorted(scored)[:k], 1):
            out.append((item, r, None if i == math.inf else i, -s))
    return sorted(out, key=str)


def ask(spark, rows, items, k=5):
    docs = spark.createDataFrame([(i, t, "r", "s", "q") for i, t in rows], SCHEMA).repartition(5)
    asked = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, rank int, doc_id int")
    return sorted((tuple(r) for r in R.search(docs, asked, k=k).collect()), key=str)


def corpus(rng, n):
    vocabulary = ["the", "The", "of", "Ünder", "ünder", "x1", "é", "日本", "a_b", "don't"] + [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 40))) for _ in range(n)]
    return vocabulary, [(i, t) for i, t in enumerate(texts)] + [(n + i, "the of w1 w2") for i in range(50)] + [(9000, None), (9001, ""), (9002, "... !"), (9003, "w3 " * 20_000)]


def test_against_full_sort(spark, monkeypatch):
    rng = random.Random(5)
    vocabulary, rows = corpus(rng, 300)
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 12)))) for i in range(25)] + [(100, None), (101, ""), (102, "nowhere"), (103, "the the of w1 w2 w2"), (104, rows[7][1])]
    want = brute(rows, items, 5)
    assert ask(spark, rows, items) == want
    monkeypatch.setattr(R, "CELLS", 1)  # shards of 64 documents
    monkeypatch.setattr(R, "BLOCK_ITEMS", 7)
    assert ask(spark, rows, items) == want


def test_null_and_repeated_ids(spark):
    rows = [(1, "a b"), (1, "a b"), (None, "a b"), (2, "a b"), (3, "a c"), (4, "c")]
    got = ask(spark, rows, [(None, "b"), (7, "b")], k=4)
    assert [g[2] for g in got if g[0] == 7] == [1, 1, 2, None]
    assert sorted(map(str, (g[1:] for g in got if g[0] is None))) == sorted(map(str, (g[1:] for g in got if g[0] == 7)))
    assert ask(spark, [], [(1, "a")]) == [] and ask(spark, rows, []) == [] and ask(spark, [(1, None)], [(1, "a")]) == []


def test_stops_early_and_strictly_below():
    """Lists of 10,000 with a clear top: few are looked up. With all scores equal none may be left out."""
    rng = np.random.default_rng(0)
    n = 10_000
    impacts = rng.integers(1, 100, (3, n)).astype(np.int64)
    impacts[:, :30] += 10_000
    lists = [np.argsort(-impacts[t], kind="stable") for t in range(3)]
    empty = np.empty(0, np.int64)
    (scores, ids), looked = R.best_positions(lists, impacts, np.arange(n), (empty, empty), 20)
    total = impacts.sum(0)
    want = np.lexsort((np.arange(n), -total))[:20]
    assert ids.tolist() == want.tolist() and scores.tolist() == total[want].tolist() and looked < 200
    flat = np.ones((2, 500), np.int64)
    lists = [np.arange(500)[::-1].copy()] * 2
    (scores, ids), looked = R.best_positions(lists, flat, np.arange(500), (empty, empty), 20)
    assert ids.tolist() == list(range(20)) and looked == 500
