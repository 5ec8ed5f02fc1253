"""Packing and mixing: exact ids, gapless places, exact totals."""

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardlens.llm import packing as P
from cardlens.llm.mixing import _each, mix_sources, source_targets, take_mix
from cardlens.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, source string, _copies string, length string"


@pytest.fixture(scope="module")
def full():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


TEXTS = [
    "", " ", "Hello, World! it's they'll DON'T 'sup", "Ünï çödé ß ÀÉ ½ ² 12345", "a<|endoftext|>b <|startoftext|>", "Σίσυφος ΟΔΟΣ", "日本語 text 🎉", "tab\tnew\nline\r\x0b\x0c\x85\xa0end",
    "é combining", "\x1c\x1d odd \x00 control \x7f", "!!!'s ...'re--'t", "«quoted»   para", "x" * 300, "İstanbul ǅ ﬁ", "'S 'T",
]


def test_ids_are_the_tokenizers(full):
    rng = random.Random(3)
    alphabet = "abcXYZ éÉßµªº½1'’-!?\n\t<|>Σ日"
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    tok = P.WordTokenizer(tokenizer_path())
    for t in texts:
        assert np.frombuffer(tok.ids(t), "<u4").tolist() == full.encode(t, add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json"])
def test_other_files_go_through_the_library(name):
    from tokenizers import Tokenizer

    tok, other = P.WordTokenizer(tokenizer_path(name)), Tokenizer.from_file(tokenizer_path(name))
    assert not tok.by_word and P.WordTokenizer(tokenizer_path()).by_word
    for text in TEXTS:
        assert np.frombuffer(tok.ids(text), "<u4").tolist() == other.encode(text, add_special_tokens=False).ids


def test_fullest_bins_are_fullest():
    rng = random.Random(2)
    for _ in range(60):
        cap = rng.randint(5, 20)
        counts = {n: rng.randint(0, 3) for n in rng.sample(range(1, cap + 1), rng.randint(1, min(6, cap)))}
        left = {n: c for n, c in counts.items() if c}
        for chosen, bins in P.fullest_bins(counts, cap):
            assert sum(n * k for n, k in chosen) <= cap
            for _ in range(bins):
                best = max(
                    s for s in (sum(n * k for n, k in zip(left, ks)) for ks in itertools.product(*[range(c + 1) for c in left.values()])) if s <= cap
                )
                assert sum(n * k for n, k in chosen) == best
                for n, k in chosen:
                    left[n] -= k
                    assert left[n] >= 0
        assert not any(left.values())
    with pytest.raises(ValueError):
        P.fullest_bins({0: 1}, 5)


def check_packed(rows, docs, full, cap):
    by_row = {}
    for r in rows:
        by_row.setdefault(r["row_uid"], []).append(r)
    assert len(by_row) == len(docs)
    seen = []
    for pieces in by_row.values():
        pieces.sort(key=lambda r: r["piece"])
        seen.append((pieces[0]["id"], tuple((p["start"], p["length"], p["ids_crc32"]) for p in pieces)))
    expected = []
    for i, t in docs:
        ids = np.array([*full.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        expected.append((i, tuple((a, len(ids[a : a + cap]), zlib.crc32(ids[a : a + cap].tobytes())) for a in range(0, len(ids), cap))))
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    assert sorted(seen, key=key) == sorted(expected, key=key)
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= cap
    return bins


def test_pack_documents(spark, full):
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choice(["on", "the", "Tion", "é!"]) for _ in range(rng.randint(0, 90)))) for i in range(120)]
    docs += [(None, None), (5, docs[5][1]), (7, ""), *zip(range(200, 260), ["same text here"] * 60)]
    table = spark.createDataFrame([(i, t, "s", "c", "l") for i, t in docs], SCHEMA)
    rows = P.pack_documents(table, tokenizer_path(), capacity=32, with_ids=True).collect()
    bins = check_packed(rows, docs, full, 32)
    assert len(bins) <= -(-sum(r["length"] for r in rows) // 32) + 1
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in rows)
    assert P.pack_documents(table.limit(0), tokenizer_path()).collect() == []


def water_level(sizes, weights, share, cap):
    total, targets = share * sum(s for _, s in sizes), {}
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {k: weights[i % len(weights)] for i, (k, _) in enumerate(order)}
    open_ = {k: s for k, s in sizes}
    while open_:
        left = total - sum(targets.values())
        per = left / sum(weight[k] for k in open_)
        full = [k for k in open_ if per * weight[k] > cap * open_[k]]
        if not full:
            targets |= {k: per * weight[k] for k in open_}
            break
        for k in full:
            targets[k] = cap * open_.pop(k)
    return targets


def test_targets(spark):
    rng = random.Random(6)
    for _ in range(4):
        sizes = [(f"s{i}", rng.choice([0, 5, 100, 1000, 90000])) for i in range(rng.randint(1, 9))] + [(None, 50)]
        got = {r["source"]: r["target"] for r in source_targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
        assert got == pytest.approx(water_level(sizes, (5, 2, 1), 1.5, 2.0))


def test_mixing(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * rng.randint(0, 40)), rng.choice(["hot", "hot", "hot", "b", "c", None]), "c", "l") for i in range(3000)]
    rows += [(1, "w w", "hot", "c", "l")] * 4 + [(None, None, "b", "c", "l")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = mix_sources(docs)
    out = got.collect()
    assert sorted(map(tuple, out), key=str) == sorted(map(tuple, got.repartition(7).collect()), key=str)
    assert sorted((r["id"] is None, r["id"] or 0, r["size"]) for r in out) == sorted((i is None, i or 0, len((t or "").split())) for i, t, *_ in rows)
    sizes = {}
    for _, t, s, *_ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    targets = water_level(list(sizes.items()), (5, 2, 1), 1.5, 2.0)
    for s in sizes:
        mine = [r for r in out if r["source"] == s]
        assert mine[0]["source_size"] == sizes[s] and mine[0]["target"] == pytest.approx(targets[s])
        assert abs(sum(r["taken"] for r in mine) - targets[s]) <= 40
    assert all(r["taken"] == r["size"] * r["copies"] and r["copies"] <= 2 for r in out)
    assert mix_sources(docs.limit(0)).collect() == []


def test_copies_are_fair(spark):
    """Over seeds, each document is taken about as often as its source's rate says."""
    docs = spark.createDataFrame([(i, "w " * (1 + i % 7), s, "c", "l") for i in range(40) for s in ("a", "b", "d")], SCHEMA)
    total, rate = {}, None
    for seed in range(12):
        for r in mix_sources(docs, seed=seed).filter("source = 'b'").collect():
            total[r["id"]] = total.get(r["id"], 0) + r["copies"]
            rate = r["target"] / r["source_size"]
    mean = sum(total.values()) / len(total) / 12
    assert abs(mean - rate) < 0.05 and all(abs(v / 12 - rate) <= 0.6 for v in total.values())


def test_many_rows_alike_are_dealt_in_parts(spark):
    items = spark.createDataFrame([(1, "a", 3, 9000), (2, "a", 3, 2), (None, None, 0, 5000)], "id long, source string, size long, count long")
    got = _each(items).collect()
    for i, n in ((1, 9000), (2, 2), (None, 5000)):
        assert sorted(r["dup"] for r in got if r["id"] == i) == list(range(1, n + 1))
    docs = spark.createDataFrame([(1, "a", "w w w")] * 6000 + [(2, "b", "w")] * 30, "doc_id long, source string, text string")
    rows = mix_sources(docs).collect()
    assert len(rows) == 6030 and abs(sum(r["taken"] for r in rows if r["source"] == "a") - rows[0]["target"] if rows[0]["source"] == "a" else 0) <= 3


def test_take_mix(spark, tmp_path):
    rows = [(i % 50, "w " * (i % 9), ("a", "b")[i % 2], "mine", "l") for i in range(200)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    mix = take_mix(docs)
    assert mix.columns == docs.columns and {r["_copies"] for r in mix.collect()} == {"mine"}
    taken = mix.groupBy("source").agg(F.sum(F.size(F.filter(F.split("text", " "), lambda w: w != ""))).alias("n"))
    whole = {s: sum(len(t.split()) for _, t, x, *_ in rows if x == s) for s in "ab"}
    targets = water_level(list(whole.items()), (5, 2, 1), 1.5, 2.0)
    assert all(abs(r["n"] - targets[r["source"]]) <= 8 for r in taken.collect())
