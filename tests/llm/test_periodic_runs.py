"""Runs against brute force over all periods and places."""

import random

import numpy as np
import pytest

from cardlens.llm import periodic_runs as P

SCHEMA = "doc_id long, text string, runs string, collapsed string, n_words string"


def brute(words, least=12):
    n, best = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i < n - p:
            if words[i] != words[i + p]:
                i += 1
                continue
            s = i
            while i < n - p and words[i] == words[i + p]:
                i += 1
            if i - s >= p and i - s + p >= least:
                best.setdefault((s, i + p - s), p)  # the smallest period comes first
    return sorted((s, n, p) for (s, n), p in best.items())


def brute_collapsed(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts(rng):
    def some(n, k):
        return [rng.choice("abcdefghijklmnopqrstuvwxyz"[:k]) for _ in range(n)]

    out = []
    for _ in range(60):
        p = rng.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 31, 33, 40, 64, 70])
        u = some(p, rng.choice([1, 2, 3, 26]))
        body = (u * 12)[: rng.randint(p, 6 * p + 3)]
        out.append(some(rng.randint(0, 20), 3) + body + some(rng.randint(0, 20), 3))
    for k in (1, 2, 3):
        out += [some(rng.randint(0, 300), k) for _ in range(10)]
    fib = ["a"], ["a", "b"]
    while len(fib[1]) < 250:
        fib = fib[1], fib[1] + fib[0]
    out += [fib[1], ["a", "b", "b", "a"] * 30, (["a"] * 20 + ["b"]) * 8, (["a", "b"] * 12 + ["a"]) * 2 + ["a", "b"] * 9, ["a"] * 40 + ["b"] + ["a"] * 40 + ["b"] + ["a"] * 39]
    out += [(["a"] * 9 + ["b"] + ["a"] * 12 + ["c"]) * 7]
    thue = [0]
    while len(thue) < 256:
        thue += [1 - t for t in thue]
    out += [[f"w{t}" for t in thue]]
    line = some(45, 26)
    out += [line + some(5, 26) + line + some(5, 26) + line + some(9, 26) + line * 3]
    return out


@pytest.mark.parametrize("short", [8, 32])
def test_all_runs(short):
    """With periods from 8 on found by minimizers, scales up to 128 are all reached."""
    cases = texts(random.Random(3))
    for words, runs in zip(cases, P._search([[w.encode() for w in c] for c in cases], P.LEAST, short)):
        got = list(zip(*(c.tolist() for c in runs)))
        assert got == brute(words), (short, " ".join(words))
        assert P.collapse([w.encode() for w in words], runs).decode() == brute_collapsed(words, got)


def test_seeds_stay_few():
    """One word 30,000 times with a rare break: the seeds don't grow with the square of a stretch."""
    x = np.zeros(30_000, np.int64)
    x[::501] = 1
    values = P._mix(x.astype(np.uint64) + np.uint64(5))
    place, lag = P._seeds(*P._minimizers(values, 64, 65), 64, 128)
    assert len(place) < 4 * len(x)
    start, length, period = P.flat_runs(np.r_[x, 2], np.array([0, len(x) + 1]))
    assert (0, len(x), 501) in set(zip(start.tolist(), length.tolist(), period.tolist()))


def test_tables(spark):
    rng = random.Random(9)
    rows = [(1, None), (2, ""), (None, "a " * 30), (4, "x\x0by\x0cz\r\n" * 9), (4, "x\x0by\x0cz\r\n" * 9), (5, "a b" * 40_000), (6, "  é x " * 20), (7, " ".join(rng.choices("ab", k=90)))]
    docs = spark.createDataFrame([(i, t, "r", "c", "n") for i, t in rows], SCHEMA).repartition(3)
    got = sorted(((r["id"] or 0, r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in P.find_runs(docs).collect()), key=str)
    want = []
    for i, t in rows:
        words = [w.decode() for w in (t or "").encode().split()]
        runs = brute(words) if len(words) < 1000 else []
        want.append((i or 0, len(words), runs, brute_collapsed(words, runs)))
    assert [g for g in got if g[0] != 5] == sorted((w for w in want if w[0] != 5), key=str)
    assert next(g for g in got if g[0] == 5)[3] == "a ba b"
    assert P.find_runs(docs.limit(0)).count() == 0
    doubled = P.find_runs(docs.filter("doc_id = 7"), edit=lambda i, w: w[:6] * 3).first()
    assert [tuple(r) for r in doubled["runs"]][0][1] >= 12
