"""Exact and near dedup against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash

from cardlens.llm import simhash as H
from cardlens.llm.components import components
from cardlens.llm.exact_dedup import drop_copies, exact_dedup

SCHEMA = "doc_id long, text string, source string, kept string, row_uid string"


def words(rng, n):
    return " ".join(rng.choice(["the", "of", "on", "ing", "tion", "er", "and", "th"]) + rng.choice(["a", "b", "c", "d", "e"]) * rng.randint(0, 3) for _ in range(n))


def table(spark, tmp_path, rows, name="docs"):
    path = str(tmp_path / name)
    spark.createDataFrame([(i, t, "s", "k", "u") for i, t in rows], SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_dedup(spark, tmp_path, keep):
    rng = random.Random(1)
    texts = [words(rng, 3) for _ in range(20)] + ["", None, "hot"]
    rows = [(i, rng.choice(texts)) for i in range(150)] + [(1000 + i, "hot") for i in range(400)] + [(None, "hot"), (None, "alone")]
    docs = table(spark, tmp_path, rows)
    got = exact_dedup(docs, keep=keep, lanes=16, fan_in=4).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    assert len(got) == len(rows)
    for r in got:
        text = next(t for t in groups if hashlib.sha256(t.encode()).hexdigest() == r["text_sha256"])
        ids = [i for i in groups[text] if i is not None]
        assert r["keep_id"] == ((max if keep == "largest" else min)(ids) if ids else None)
        assert r["group_size"] == len(groups[text])
    assert sum(r["kept"] for r in got) == len(groups)
    left = drop_copies(docs, keep=keep)
    assert left.columns == docs.columns and left.count() == len(groups)


def test_exact_dedup_keeps_one_of_repeated_rows(spark, tmp_path):
    docs = table(spark, tmp_path, [(7, "same")] * 5 + [(3, "same")])
    assert sum(r["kept"] for r in exact_dedup(docs).collect()) == 1
    assert [(r["doc_id"], r["text"]) for r in drop_copies(docs).collect()] == [(7, "same")]


def test_empty_tables(spark, tmp_path):
    docs = table(spark, tmp_path, [])
    assert exact_dedup(docs).collect() == [] and drop_copies(docs).collect() == []
    assert H.near_dedup(docs).collect() == [] and H.drop_near_copies(docs).collect() == []


@pytest.mark.parametrize("radius", [1, 2, 3, 4, 5])
def test_masks_cover_every_pair(radius):
    rng = random.Random(radius)
    for level in (0, 1):
        masks = H.covering_masks(radius, level)
        assert len(masks) == 2 ** (radius + 1) - 1
        for _ in range(2000):
            flipped = sum(1 << b for b in rng.sample(range(64), radius))
            assert any(not m & flipped for m in masks)
    assert H.free_bits(radius) <= 24


def test_shingle_hashes_and_bits():
    text = "A b  c\td"
    expected = [xxhash.xxh64_intdigest(s, 42) for s in ("a b c", "b c d")]
    assert H.shingle_hashes(text, 3).tolist() == expected
    assert H.shingle_hashes("x Y", 3).tolist() == [xxhash.xxh64_intdigest("x y", 42)]
    assert H.simhash(H.shingle_hashes(None, 3)) == 0
    many = np.array([random.Random(i).getrandbits(64) for i in range(40001)], np.uint64)
    bits = [sum(int(h) >> b & 1 for h in many.tolist()) for b in range(64)]
    assert H.simhash(many) == sum(1 << b for b in range(64) if 2 * bits[b] > len(many))


def brute(rows, n, radius):
    def fp(t):
        w = (t or "").lower().split()
        s = [" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))] if w else []
        c = [sum(xxhash.xxh64_intdigest(x, 42) >> b & 1 for x in s) for b in range(64)]
        return sum(1 << b for b in range(64) if 2 * c[b] > len(s))

    f = [fp(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (f[i] ^ f[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    best = {}
    for k, (i, _) in enumerate(rows):
        best[find(k)] = min(best.get(find(k), i), i)
    return {i: (f"{f[k]:016x}", best[find(k)]) for k, (i, _) in enumerate(rows)}


@pytest.mark.parametrize("bucket", [2048, 2])
def test_near_dedup(spark, tmp_path, bucket):
    rng = random.Random(5)
    base = words(rng, 80).split()
    rows = [(i, words(rng, rng.randint(1, 60))) for i in range(60)] + [(200, None), (201, " "), (202, "")]
    for i in range(300, 420):
        w = list(base)
        w[rng.randrange(80)] = "zz%d" % rng.randint(0, 9)
        rows.append((i, " ".join(w)))
    rows += [(500, rows[0][1]), (501, rows[0][1])]
    got = {r["id"]: (r["fingerprint"], r["component_id"]) for r in H.near_dedup(table(spark, tmp_path, rows), bucket=bucket).collect()}
    assert got == brute(rows, 3, 3)


def test_near_dedup_keeps_one_row_a_group(spark, tmp_path):
    rows = [(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (9, "q r s t u v")]
    got = H.near_dedup(table(spark, tmp_path, rows)).collect()
    assert sum(r["kept"] for r in got) == 2 and {r["component_id"] for r in got} == {5, 9}


def test_near_copies(spark, tmp_path):
    rng = random.Random(9)
    base = [words(rng, 300).split() for _ in range(6)]
    rows = [(i, " ".join(b)) for i, b in enumerate(base)]
    for i, b in enumerate(base):
        w = list(b)
        for at in (40, 180):
            w[at] = "changed%d" % i
        rows.append((100 + i, " ".join(w)))
    rows += [(50, "one two"), (51, "two one"), (52, None)]
    left = H.drop_near_copies(table(spark, tmp_path, rows))
    assert sorted(r["doc_id"] for r in left.collect()) == [0, 1, 2, 3, 4, 5, 50, 51, 52]


def _jaccard(a, b, n=5):
    x, y = ({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} for w in (a.split(), b.split()))
    return len(x & y) / len(x | y)


def _turned(base, *cuts):
    """``base`` with some stretches backwards: other shingles, but the same words and fingerprints."""
    w = list(base)
    for at, n in cuts:
        w[at : at + n] = w[at : at + n][::-1]
    return " ".join(w)


def test_near_copies_decides_on_whole_texts(spark, tmp_path):
    """Long texts just above and below the limit, which a sample of their shingles can't tell apart."""
    rng = random.Random(21)
    rows, alike = [], set()
    for i in range(60):
        base = [f"w{rng.randrange(10**9)}" for _ in range(2000)]
        rows += [(i, " ".join(base)), (1000 + i, _turned(base, (rng.randrange(1500), 213 + i % 10)))]
        if _jaccard(rows[-1][1], rows[-2][1]) >= 0.8:
            alike.add(1000 + i)
    assert 10 < len(alike) < 50
    got = {r["id"]: r["component_row"] for r in H.near_copies(table(spark, tmp_path, rows)).collect()}
    assert {i for i in range(1000, 1060) if got[i] == got[i - 1000]} == alike


@pytest.mark.parametrize("bucket", [2048, 2])
def test_near_copies_of_a_family(spark, tmp_path, monkeypatch, bucket):
    """Copies that were edited independently: many are near some of the others, but not the first."""
    monkeypatch.setattr(H, "WIDE_BUCKET", 16 * bucket)
    rng = random.Random(22)
    base = [f"w{rng.randrange(10**9)}" for _ in range(200)]
    rows = [(i, _turned(base, (rng.randrange(185), 14), (rng.randrange(190), 5))) for i in range(100)]
    for i in range(100, 120):  # one bit or so of the fingerprints differs
        w = rows[i - 100][1].split()
        w[rng.randrange(200)] = f"z{i}"
        rows.append((i, " ".join(w)))
    rows += [(500, rows[3][1]), (501, rows[3][1])]

    def fps(t):
        h = np.array([xxhash.xxh64_intdigest(w, 42) for w in set(t.split())], np.uint64)
        return [H.simhash(H._remix(h, k)) for k in range(4)]

    prints, parent = [fps(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if any((x ^ y).bit_count() <= 3 for x, y in zip(prints[i], prints[j])) and _jaccard(rows[i][1], rows[j][1]) >= 0.8:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    expected = {i for k, (i, _) in enumerate(rows) if find(k) == k}
    assert 1 < len(expected) < 100
    got = H.near_copies(table(spark, tmp_path, rows), bucket=bucket).collect()
    assert {r["id"] for r in got if r["kept"]} == expected
    row = {r["row_uid"]: r["id"] for r in got}
    assert {r["id"]: row[r["component_row"]] for r in got} == {i: rows[find(k)][0] for k, (i, _) in enumerate(rows)}


def test_bucket_sums_bound_what_sets_share():
    rng = np.random.default_rng(4)
    for n in (0, 1, 30, 200, 3000):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.r_[a[: n * 4 // 5], rng.integers(0, 1 << 63, n // 4, dtype=np.uint64)])
        x, y = H.bucket_sums(a), H.bucket_sums(b)
        m = min(len(x), len(y))
        shared = int(np.minimum(H._folded(x[None], m), H._folded(y[None], m)).sum())
        exact = len(np.intersect1d(a, b))
        assert x.sum() == len(a) and exact <= shared <= exact + 0.06 * n + 2
    crowded = np.arange(0, 1 << 20, 1 << 10, dtype=np.uint64)  # all in one bucket until there are many
    assert H.bucket_sums(crowded).sum() == len(crowded)


@pytest.mark.parametrize("few", [0, 1 << 17])
def test_components_of_chains_and_stars(spark, monkeypatch, few):
    monkeypatch.setattr("cardlens.llm.components.FEW", few)
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(200, 200), (301, 300), (300, 301)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}, 300: 300, 301: 300}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_rows_keep_their_numbers(spark, tmp_path):
    """The stages that drop or repeat rows stay right if a scan is split otherwise at the action."""
    from cardlens.llm.mixing import take_mix

    rows = [(i, f"text {i % 200} " * 3) for i in range(400)]
    path = str(tmp_path / "many")
    spark.createDataFrame([(i, t, "s", "k", "u") for i, t in rows], SCHEMA).repartition(8).write.parquet(path)
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]
    try:
        plans = {}
        for k, v in zip(keys, ("128m", "128m")):
            spark.conf.set(k, v)
        for name, f in (("exact", lambda d: drop_copies(d, keep="smallest")), ("near", lambda d: H.drop_near_copies(d, words=2, similarity=0.99)), ("mix", take_mix)):
            plans[name] = f(spark.read.parquet(path))
        for k, v in zip(keys, ("4k", "1")):
            spark.conf.set(k, v)
        assert sorted(r["doc_id"] for r in plans["exact"].collect()) == list(range(200))
        assert len({r["text"] for r in plans["near"].collect()}) == plans["near"].count() == 200
        assert plans["mix"].count() == 600
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)
