"""The pipeline's stages against brute force on a small corpus."""

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from cardlens.llm.queries import tokenizer_path

PARTS = {"en": "the ing tion and of er ly thing was", "de": "der ung keit und sch lich ein ist"}


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(PARTS[lang].split()) for _ in range(rng.randint(1, 4))) for _ in range(n))


def corpus():
    rng = random.Random(11)
    rows = [(i, prose(rng, "en" if i % 3 else "de", rng.randint(40, 160)), "en" if i % 3 else "de", f"src{i % 4}") for i in range(80)]
    rows += [(100 + i, rows[i][1], rows[i][2], "src0") for i in range(12)]
    for i in range(12, 24):
        w = rows[i][1].split()
        w[len(w) // 2] = "changed"
        rows.append((200 + i, " ".join(w), rows[i][2], "src1"))
    return [*rows, (900, None, "en", "src0"), (901, "12 34 !!", "en", "src0"), (902, "", "de", None), (0, rows[0][1], rows[0][2], "src0")]


def alike(a, b):
    def shingles(t):
        w = t.lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y) >= 0.8


def test_stages(spark, tmp_path):
    sf = str(tmp_path)
    rows = [(i, t, lang, s, len(t or "")) for i, t, lang, s in corpus()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{sf}/documents.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        out.write.parquet(f"{sf}/{name}.parquet")
        docs = spark.read.parquet(f"{sf}/{name}.parquet")
        kept[name] = docs.collect()
        assert name == "packing" or docs.columns == columns
    assert len(kept["language_id"]) == sum(any(c.isalpha() for c in t or "") for _, t, *_ in rows)
    first = {}
    for r in kept["language_id"]:
        first[r["text"]] = min(first.get(r["text"], r["doc_id"]), r["doc_id"])
    assert sorted(r["doc_id"] for r in kept["exact_dedup"]) == sorted(first.values())
    texts = {r["doc_id"]: r["text"] for r in kept["exact_dedup"]}
    gone = {i for i in texts for j in texts if j < i and alike(texts[i], texts[j])}
    assert gone and {r["doc_id"] for r in kept["simhash_near_dedup"]} == set(texts) - gone
    left = {r["doc_id"]: r for r in kept["simhash_near_dedup"]}
    times = {i: sum(r["doc_id"] == i for r in kept["mixing"]) for i in left}
    assert set(r["doc_id"] for r in kept["mixing"]) <= set(left) and max(times.values()) <= 2
    words = sum(len(r["text"].split()) for r in left.values())
    taken = sum(len(r["text"].split()) for r in kept["mixing"])
    assert abs(taken - 1.5 * words) <= 160 * 5
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(tokenizer_path())
    tokens = sum(times[i] * (len(full.encode(left[i]["text"], add_special_tokens=False).ids) + 1) for i in left)
    assert sum(r["length"] for r in kept["packing"]) == tokens
    sums = docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert max(r["n"] for r in sums) <= 2048 and len(sums) <= -(-tokens // 2048) + 1
    assert np.isclose(corpus_pipeline.run(spark, sf).count(), len(kept["packing"]), atol=20)


def test_empty(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
