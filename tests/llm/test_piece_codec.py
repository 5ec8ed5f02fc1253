"""Encoding and decoding against the library, id for id."""

import random

import pytest
import sentencepiece

from cardlens.llm.piece_codec import LONG, PieceModel, decode_pieces, encode_pieces
from cardlens.llm.queries import tokenizer_path

PATH = tokenizer_path("piece_bpe_32k.model")
HARD = [
    "", " ", "  a", "a  b ", "▁a ▁", " \n x\n\n", "\t", "é日本語テスト", "<s> </s><0x0A><unk>", "\x00a\x7f", "﷽ ﬁ Å", "a​b", "\U0001f600\U0001f468‍\U0001f469",
    "x" * 1000, " " * 700 + "end", "ab" * 400, "=" * 300 + "-" * 300, "https://example.com/" + "q1" * 300, "don't stop" * 50, "▁" * 40, "The\r\nend. " * 30, "Straße ÀÉÎ ñandú größer",
]


@pytest.fixture(scope="module")
def pair():
    return PieceModel(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)


def strings(rng, n):
    alphabets = ["abc", "the ing er", "aeiou \n", "etaoin shrdlu.,;:'\"-", "".join(map(chr, range(32, 127))), "日本語中文字が", "".join(map(chr, range(0x80, 0x250))), "\U0001f600▁ a<0x>s/"]
    return ["".join(rng.choices(rng.choice(alphabets), k=rng.randint(1, 120))) for _ in range(n)]


def ids(model, texts):
    import numpy as np

    return [np.frombuffer(b, "<i4").tolist() for b in model.encode(texts)]


def test_ids_of_the_library(pair):
    model, library = pair
    texts = HARD + strings(random.Random(2), 1500)
    got = ids(model, texts)
    for text, own in zip(texts, got):
        assert own == library.encode(text), repr(text)
        assert model.decode(own + [model.end]) == library.decode(own + [model.end]), repr(text)
    assert got == ids(model, texts)  # remembered words give the same


def test_heap_and_rounds_agree(pair, monkeypatch):
    model, library = pair
    texts = HARD[:13] + strings(random.Random(4), 200)
    monkeypatch.setattr("cardlens.llm.piece_codec.LONG", 1)
    model.known.clear()
    assert ids(model, texts) == [library.encode(t) for t in texts] and LONG > 1
    model.known.clear()


def test_decode_any_ids(pair):
    model, library = pair
    rng = random.Random(6)
    some = [0, 1, 2, 259, 261, 28705] + list(range(3, 259))
    for _ in range(3000):
        own = [rng.choice(some) if rng.random() < 0.7 else rng.randrange(model.n) for _ in range(rng.randint(0, 9))]
        assert model.decode(own) == library.decode(own), own
    with pytest.raises(ValueError):
        model.decode([model.n])


def test_tables(spark, pair):
    library = pair[1]
    rows = [(1, None), (2, ""), (None, "one"), (3, "two  words"), (3, "two  words"), (4, "long text, and more of it.\n" * 20_000)]
    docs = spark.createDataFrame([(i, t, 5, "x") for i, t in rows], "doc_id long, text string, ids int, id string").repartition(3)
    got = decode_pieces(encode_pieces(docs, PATH), PATH, to="back").collect()
    assert sorted((r["id"] or 0, r["ids"], r["back"]) for r in got) == sorted((i or 0, library.encode(t or "", add_eos=True), t or "") for i, t in rows)
    assert encode_pieces(docs.limit(0), PATH).count() == 0
    odd = spark.createDataFrame([(None, "a"), ([], "b"), ([261], "c")], "ids array<int>, TEXT string")
    assert {r["text"] for r in decode_pieces(odd, PATH).collect()} == {None, "", "t"}
