"""Language ID, fingerprints, licences, pages, URLs and chats against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardlens.llm import chat_format as C
from cardlens.llm import fingerprint as S
from cardlens.llm import language_id as L
from cardlens.llm import license_scan as K
from cardlens.llm import url_filter as U
from cardlens.llm.html_text import extract_text, main_text

PARTS = {"en": "the ing tion and of er ly thing was", "de": "der ung keit und sch lich ein ist", "fr": "le eau tion ment de la que est", "es": "el cion que ado la mente los por"}


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(PARTS[lang].split()) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(1)
    return [(i, prose(rng, lang, rng.randint(4, 60)), lang) for i, lang in enumerate(["en", "de", "fr", "es"] * 80)]


def test_language_id(spark, labelled):
    rows = [(i, t, lang, 1.0) for i, t, lang in labelled]
    odd = [(5000, None, "en", 1.0), (5001, "", None, 1.0), (5002, "12 %% 34", "de", 1.0), (None, "the thing was", None, 1.0), (5003, "the thing " * 60000, None, 1.0)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, score double")
    got = {r["doc_id"]: r for r in L.identify(docs).collect()}
    assert len(got) == len(rows) + len(odd)
    for i in (5000, 5001, 5002):
        assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
    assert got[None]["lang_pred"] == "en" and got[5003]["lang_pred"] == "en" and not got[None]["held_out"]
    test = [(i, lang) for i, _, lang in labelled if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i]["held_out"] for i, _ in test) and np.mean([got[i]["lang_pred"] == lang for i, lang in test]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got.values())
    kept = L.keep_identified(docs)
    assert kept.columns == docs.columns and {r["score"] for r in kept.collect()} == {1.0} and kept.count() == len(rows) + 2
    assert L.identify(docs.limit(0)).collect() == []


def test_mixtures(spark, labelled):
    languages, log_p = L.learn(spark.createDataFrame(labelled, "doc_id long, text string, lang string"))
    rng = random.Random(2)
    share, _ = L.infer(log_p, prose(rng, "en", 200) + " " + prose(rng, "de", 100))
    found = {languages[j]: round(float(share[j]), 2) for j in np.flatnonzero(share > 0.05)}
    assert set(found) == {"en", "de"} and found["en"] > found["de"] > 0.2
    share, _ = L.infer(log_p, prose(rng, "fr", 200))
    assert (share > 0).sum() == 1 and languages[int(share.argmax())] == "fr"


def spaced(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    return " " + " ".join(words) + " " if words else " "


def test_language_counts_are_whole(spark, monkeypatch):
    rng = random.Random(5)
    texts = ["", "a", " .", "Äb c" * 50, "".join(rng.choice("aB é.-1ß\n") for _ in range(700))]
    for chunk in (1, 2, 3, 7, 64, 1 << 18):  # wherever a text is cut
        monkeypatch.setattr(L, "_CHUNK", chunk)
        for text in texts:
            b, n = L.bucket_counts(text)
            line, grams = spaced(text), Counter()
            for k in range(1, L.GRAM + 1):
                for i in range(len(line) - k + 1):
                    if line[i : i + k].strip():
                        h = k
                        for c in line[i : i + k]:
                            h = (h * 0x9E3779B97F4A7C15 + ord(c)) & (1 << 64) - 1
                        h = (h ^ h >> 29) * 0xBF58476D1CE4E5B9 & (1 << 64) - 1
                        grams[(h >> 32) % L.BUCKETS] += 1
            assert dict(zip(b.tolist(), n.tolist())) == grams
    assert L.learn(spark.createDataFrame([], "lang string, text string"))[0] == []


def test_inference_against_brute_force():
    rng, penalty = random.Random(6), 1.0
    p = np.random.default_rng(6).dirichlet(np.full(L.BUCKETS, 0.01), 3).T + 1e-9
    log_p = np.log(p / p.sum(axis=0)).astype(np.float32)

    def likelihood(n, share):
        return sum(c * math.log(sum(s * math.exp(float(log_p[b, j])) for j, s in share.items())) for b, c in n.items())

    for text in (prose(rng, "en", 3), prose(rng, "en", 40), prose(rng, "de", 30) + prose(rng, "fr", 30), "ab"):
        b, k = L.bucket_counts(text)
        n = dict(zip(b.tolist(), k.tolist()))
        share, _ = L.infer(log_p, text, penalty, rounds=3000)
        found = {j: float(share[j]) for j in np.flatnonzero(share)}
        assert sum(found.values()) == pytest.approx(1, abs=1e-6)
        cost = penalty * math.log(sum(n.values()) + 1)
        value = likelihood(n, found) - len(found) * cost
        # no mixture of a grid over all three languages is better by more than the rounding of EM
        steps = [i / 10 for i in range(11)]
        for x in steps:
            for y in steps:
                if x + y <= 1.0001:
                    mix = {j: s for j, s in enumerate((x, y, 1 - x - y)) if s > 1e-9}
                    assert likelihood(n, mix) - len(mix) * cost <= value + 0.05


def gram_hash(points, n):
    """The polynomial hash and its finalizer, in Python integers."""
    h, top = 0, (1 << 64) - 1
    for x in points[:n]:
        h = (h * 0x9E3779B97F4A7C15 + x) & top
    for m in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h = (h ^ h >> 33) * m & top
    return h ^ h >> 33


def syncmers(text, k, s):
    """Every k-mer with a code point of the text whose least inner s-mer is at an edge."""
    points = [0x110000 + i for i in range(1, k)] + [ord(c) for c in text] + [0x110000 + i for i in range(k, 2 * k - 1)]
    out = []
    for i in range(len(text) + k - 1 if text else 0):
        kmer = points[i : i + k]
        inner = [gram_hash(kmer[j:], s) for j in range(k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.append((gram_hash(kmer, k) >> 32, i))
    return out


def dice(a, b):
    a, b = Counter(h for h, _ in a), Counter(h for h, _ in b)
    both = sum(a.values()) + sum(b.values())
    return 2 * sum((a & b).values()) / both if both else 1.0


def test_anchors_are_closed_syncmers():
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdé 😀") for _ in range(n)) for n in (0, 1, 5, 30, 39, 40, 0, 200, 900)]
    for text, (h, at), found in zip(texts, map(S.anchors, texts), S.batch_anchors(texts)):
        assert list(zip(h.tolist(), at.tolist())) == syncmers(text, S.K, S.S) == list(zip(*(x.tolist() for x in found)))
        assert all((x == y).all() for x, y in zip(S.decode(S.encode((h, at))), (h, at)))
        assert not text or len(h)
    long = "".join(rng.choice("abcdefgh") for _ in range(S._CHUNK + 500))
    h, at = S.anchors(long)
    inside = dict(zip(at.tolist(), h.tolist()))
    for x, i in zip(*S.anchors(long[S._CHUNK - 300 : S._CHUNK + 300])):
        if S.K <= i < 600:  # anchors don't depend on what is around them
            assert inside[S._CHUNK - 300 + i] == x


def test_fingerprint_edits(spark):
    rng = random.Random(4)
    rows = [(i * 3 % 61, prose(rng, "en", rng.randint(1, 50))) for i in range(61)] + [(500, None), (501, ""), (502, "ab")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    rows.sort()
    for slices in (1, 7, 40):
        got = {r["id"]: r for r in S.fingerprint_edits(docs, slices).collect()}
        assert len(got) == len(rows)
        for k, (i, t) in enumerate(rows):
            t, following = t or "", rows[(k + 1) % len(rows)][1] or ""
            changed = t[: len(t) - len(t) // 4] + following[: len(t) // 4]
            r = got[i]
            assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(changed.encode()).hexdigest())
            own, other, after = (syncmers(x, S.K, S.S) for x in (t, changed, following))
            assert [list(zip(*(x.tolist() for x in S.decode(r[f])))) for f in ("fingerprint", "edited_fingerprint")] == [own, other]
            assert (r["near_edited"], r["near_next"]) == pytest.approx((dice(own, other), dice(own, after)))
            alike = next((j for j, (x, y) in enumerate(zip(own, other)) if x != y), min(len(own), len(other)))
            assert r["same_until"] == (min(own[alike - 1][1] + 1, len(t)) if alike else 0)
    one = S.fingerprint_edits(docs.filter("doc_id = 0")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert S.fingerprint_edits(docs.limit(0)).collect() == []
    hot = spark.createDataFrame([(None, f"{i} is the number of it") for i in range(200)], "doc_id long, text string").repartition(3)
    chain = S.fingerprint_edits(hot, 16).collect()  # rows without an id are dealt over all slices, and form one ring
    assert len({r["edited_sha256"] for r in chain}) == 200 and len({r["fingerprint"] for r in chain}) == 200
    same = spark.createDataFrame([(1, "x y z"), (1, "x y z"), (None, "x y z")], "doc_id long, text string")
    assert len({r["fingerprint"] for r in S.fingerprint_edits(same).collect()}) == 1 and S.fingerprint_edits(same).count() == 3


def test_licenses(spark):
    mit = next(t for n, t in K.KNOWN if n == "MIT")
    rows = [
        (1, "Copyright (c) 2020 Some One\n\n" + mit.upper().replace(",", " ,")), (2, mit.replace("Software", "software") + "\n"), (3, mit + " except on Mondays"), (4, None), (5, ""),
        (6, "prose\nReleased under the  MIT licence!\nmore"), (7, "the GNU thing is licensed"), (7, "the GNU thing is licensed"),
    ]
    docs = spark.createDataFrame([(i, t, "mine") for i, t in rows], "doc_id long, text string, _known string")
    got = K.scan_licenses(docs).collect()
    assert [r["license"] for r in sorted(got, key=lambda r: r["doc_id"])] == ["MIT", "MIT", None, None, None, None, None, None]
    assert {r["doc_id"]: list(r["notices"]) for r in got}[6] == ["MIT"] and len(got) == 8
    assert K.scan_licenses(docs.limit(0)).collect() == [] and {r["_known"] for r in got} == {"mine"}


def test_whole_licenses_in_other_layouts(spark):
    texts = dict(K.known_texts())

    def layout(t):
        return "\r\n\r\n".join(f"  * {x}  ".replace(" license ", "\tlicence ").upper() for x in t.split("\n"))

    rows = [(i, n, f"Copyright Jane Doe 2020\n(c) 2019 The Regents\n\n{layout(t)}") for i, (n, t) in enumerate(sorted(texts.items())) if not t.lower().startswith("copyright")]
    rows += [(100, "GPL-3.0", "\r\n".join("   " + x for x in texts["GPL-3.0"].split("\n"))), (101, None, texts["Apache-2.0"] * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, _digest string, text string").withColumn("_license", F.lit("own"))
    got = K.scan_licenses(docs).collect()
    assert all(r["license"] == r["_digest"] and r["_license"] == "own" for r in got) and len(got) == len(rows)
    mine = spark.createDataFrame([("House-1.0", "Do as you\nlike.")], "license string, text string")
    own = K.scan_licenses(spark.createDataFrame([(1, "© 2020 Me\ndo as YOU like"), (2, "MIT License")], "doc_id long, text string"), known=mine).collect()
    assert {r["doc_id"]: r["license"] for r in own} == {1: "House-1.0", 2: None}


def test_every_line_is_looked_up(spark):
    mine = spark.createDataFrame([("PD", "This work is in the public domain."), ("PD", "this WORK is in the public domain")], "license string, text string")
    docs = spark.createDataFrame([(1, "prose\n  this work is in the PUBLIC domain.\nmore"), (2, "prose"), (3, None), (4, "")], "doc_id long, text string")
    assert {r["doc_id"]: r["notices"] for r in K.scan_licenses(docs, known=mine).collect()} == {1: ["PD"], 2: [], 3: [], 4: []}
    many = spark.range(K.MOST_KNOWN + 1).select(F.lit("x").alias("license"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    with pytest.raises(ValueError):
        K.scan_licenses(docs, known=many)
    assert K.scan_licenses(docs, known=many.filter(f"id < {K.MOST_KNOWN}")).count() == 4


def test_canonical_texts_against_brute_force(spark):
    rng = random.Random(9)
    atoms = ["licence", "Copyright (c) 2020 X\n", "\n", " ", ", ", "sub-licence", "©", "All rights reserved.", " ÄB ", "per cent", "word", "copyright owner", "copyright Me 1999", "organisations"]
    texts = ["".join(rng.choice(atoms) for _ in range(rng.randint(0, 14))) for _ in range(300)]

    def canonical(t):
        t = t.translate(str.maketrans(K._UPPER, K._LOWER))
        for pattern, with_ in K.RULES:
            t = re.sub(pattern, with_, t, flags=re.ASCII)
        return t.strip(" ")

    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", K.canonical(F.col("t")).alias("c")).collect()
    assert [r["c"] for r in got] == [canonical(r["t"]) for r in got]


def test_main_text():
    body = "".join(f"<p>Paragraph {i} &amp; some\n  more <b>words</b> in it.</p>" for i in range(4))
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var x="</p><article>";</script></head><body><header><a href=/>Home</a></header>
    <nav><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></nav><!-- <p>no</p> --><div class="cookie-notice">We use cookies</div><div class="content"><h1>Head<br>line</h1>{body}
    <p>End.<aside>side</aside><form><input>Search <button>Go</button></form></div><div id="comments"><p>nice</p></div><footer>&copy; 2020</footer></body></html>"""
    expected = ["Head", "line", *[f"Paragraph {i} & some more words in it." for i in range(4)], "End."]
    assert main_text(page) == "\n".join(expected)
    article = "<body><div class=ad>Buy now and save a lot of money today</div><article><h1>A</h1><p><b>Only one long paragraph here, with words.<br><p>x</article><div class=sidebar>z</div>"
    assert main_text(article) == "A\nOnly one long paragraph here, with words.\nx"
    assert main_text(None) == main_text("") == main_text("<html><nav>menu</nav>") == ""
    assert main_text("just text &lt;here&gt;") == "just text <here>"
    assert main_text("<p>a<p>b</p></div></span><p>c < d & e") == "a\nb\nc < d & e"
    links = "<div>" + "".join(f"<a href=/{i}>Some linked title number {i}</a> " for i in range(30)) + "</div>"
    text = "<div><div><p>" + "Plain words of an article, " * 12 + "</p><p>and a second one. " * 3 + "</p></div></div>"
    assert main_text(f"<body>{links}{text}</body>").startswith("Plain words") and "linked" not in main_text(f"<body>{links}{text}</body>")
    assert main_text("<div>" * 5000 + "deep") == "deep"
    wrapped = "<div class='page with-sidebar'><div class=sidebar>side</div><article class=post><p>Text</p></article><section class=comments><article class=comment>nice</article></section></div>"
    assert main_text(wrapped) == "Text"


def test_extract_text(spark):
    rows = [(1, "u", "<p>é &eacute;</p>", "old"), (2, None, None, None), (2, None, None, None)]
    got = extract_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).orderBy("page_id").collect()
    assert [(r["page_id"], r["text"], r["n_chars"]) for r in got] == [(1, "é é", 3), (2, "", 0), (2, "", 0)]
    assert extract_text(spark.createDataFrame([], "page_id long, html string")).collect() == []


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
URLS = [
    "http://example.com/en/1", "https://www.Example.COM/en/1?x=1", "http://a.www.example.com/en/", "http://badexample.com/en/", "http://x.net/es/1", "http://x.net/ES/1", "x.net/fr/1",
    None, "", "://", "http://net/fr/", "ftp://q.com#f", "http://q.com?en/", "http://h://example.com/en/", "http://casino-win.org/en/1", "http://blog.weather.org/en/1", "http://é.net/fr/\n/2",
]


def expected(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url) if url else None
    host, path = (m[1], m[2]) if m else ("", "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


@pytest.mark.parametrize("joined", [False, True])
def test_url_rules(spark, joined):
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate([*URLS, URLS[0]])], "page_id long, url string, _weights string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string") if joined else RULES
    got = U.filter_urls(pages, rules).orderBy("page_id").collect()
    assert len(got) == len(URLS) + 1 and {r["_weights"] for r in got} == {"mine"}
    for r in got:
        host, path, rule, verdict = expected(r["url"])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), r["url"]
        assert r["verdict"] == (verdict or ("block" if r["unwanted_probability"] > 0.5 else "allow"))
    by_url = {r["url"]: r["verdict"] for r in got}
    assert by_url["http://casino-win.org/en/1"] == "block" and by_url["http://blog.weather.org/en/1"] == "allow"
    assert U.filter_urls(pages.limit(0), RULES).collect() == []


def test_url_model_on_held_out_urls(spark):
    """Trained on three quarters of the labelled urls, asked about the rest; whole sites are held out too."""
    rows = U.labelled_urls()
    assert len(rows) <= U.MOST_LABELLED and len(set(rows)) == len(rows)
    for part in ([i % 4 == 1 for i in range(len(rows))], [any(w in u for w in (U.UNWANTED_SITES + U.WANTED_SITES)[::4]) for u, _ in rows]):
        learn = spark.createDataFrame([r for r, out in zip(rows, part) if not out], "url string, unwanted int")
        test = spark.createDataFrame([r for r, out in zip(rows, part) if out], "url string, unwanted int")
        got = U.filter_urls(test, [], labelled=learn).collect()
        right = np.mean([(r["verdict"] == "block") == (r["unwanted"] == 1) for r in got])
        assert right > 0.85, right


def test_rules_inline_and_joined_agree(spark):
    rules = [("a.com", "/x", "allow"), ("a.com", "/x", "block"), ("com", "/", "block"), ("com", "/x/yy", "allow"), ("a.com", "/x/", "block")]
    pages = spark.createDataFrame([(i, u, "own") for i, u in enumerate(["http://a.com/x", "http://b.a.com/x/yy/z", "http://com/x/yy", None, "mailto:x", "http://net/"])], "id long, url string, _rule string")
    inline = sorted(map(tuple, U.filter_urls(pages, rules).collect()))
    joined = sorted(map(tuple, U.filter_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).select(*U.filter_urls(pages, rules).columns).collect()))
    assert inline == joined and all(r[2] == "own" for r in inline)
    with pytest.raises(Exception, match="more than"):
        U.train(spark.range(2000).select(F.col("id").cast("string").alias("url"), F.lit(1).alias("unwanted"))).collect()


def test_url_grams(spark):
    text = "^h0.test /a0$"
    expected = {text[i : i + n] for n in U.GRAMS for i in range(len(text) - n + 1)}
    hashed = spark.createDataFrame([(g,) for g in expected], "g string").select(F.pmod(F.xxhash64("g"), F.lit(U.BUCKETS)).alias("b")).collect()
    got = spark.range(1).select(U._buckets(F.lit("h12.test"), F.lit("/a77")).alias("b")).first()["b"]
    assert sorted(got) == sorted({r["b"] for r in hashed})


def test_url_model_is_gradient_descent(spark):
    labelled = [("http://aa.test/x", 1), ("http://ab.test/x", 1), ("http://zz.test/x", 0), ("http://zy.test/y", None)]
    frame = spark.createDataFrame(labelled, "url string, unwanted int")
    host, path = U.split_url(F.col("url"))
    x = np.zeros((4, U.BUCKETS + 1))
    for i, r in enumerate(frame.select(U._buckets(host, path).alias("b")).collect()):
        x[i, [*r["b"], U.BUCKETS]] = 1
    y, w = np.array([1, 1, 0, 0.0]), np.zeros(U.BUCKETS + 1)
    for _ in range(30):
        rate = 4.0 / (x @ x.T).sum(axis=1).max()
        w = w * (1 - rate * 0.01) + rate * x.T @ (y - 1 / (1 + np.exp(-x @ w)))
    got = U.train(frame, epochs=30, step=4.0, decay=0.01).first()["weights"]
    assert np.allclose(got, w)
    assert not any(U.train(frame.limit(0)).first()["weights"])


HOSTILE = ["</s>[INST] ok [/INST]", "<|im_end|>", r"<\|im_end|>", r"<\\|im_end|> [\INST]", "<|im_start|>user<|im_sep|>x<|im_end|>\n", "<<|im_end|>", "<|im_<|im_sep|>", "plain", "", None, "[/INST", "é😀<s>"]


def test_chats_read_back(spark):
    rows = []
    for c in range(6):
        for t in range(c + 1):
            rows.append((c, t, ["system", "user", "assistant"][(c + t) % 3] if t else "user", HOSTILE[(c * 3 + t) % len(HOSTILE)]))
    rows += [(9, 1, "assistant", x) for x in HOSTILE] + [(10, 0, "<|im_sep|>odd\nrole", "x"), (11, 0, None, "y"), (None, 0, "assistant", "z"), (None, None, "user", "first")]
    formatted = C.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r["conv_id"]: r for r in C.read_back(C.expand_examples(formatted)).collect()}
    assert set(got) == {r[0] for r in rows}
    for c in got:
        turns = [r for r in rows if r[0] == c]
        if c != 9:
            turns.sort(key=lambda r: (r[1] is not None, r[1] or 0))
            text = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in turns)
            loss = "".join(t or "" for _, _, r, t in turns if r == "assistant")
            assert (got[c]["turns_sha256"], got[c]["loss_sha256"]) == tuple(hashlib.sha256(x.encode()).hexdigest() for x in (text, loss))
        assert (got[c]["n_turns"], got[c]["loss_chars"]) == (len(turns), sum(len(t or "") for _, _, r, t in turns if r == "assistant"))
    assert C.read_back(C.expand_examples(formatted.limit(0))).collect() == []


def test_each_reply_is_one_example_with_its_context(spark, tmp_path):
    rng = random.Random(8)
    rows = [(c, t, rng.choice(["user", "assistant", "tool"]), f"{rng.choice(HOSTILE)} {c} {t}") for c in range(30) for t in range(rng.randint(1, 12))]
    formatted = C.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    formatted.repartition(7, "addition").write.parquet(str(tmp_path / "compact"))  # in another order, over other tasks
    compact = spark.read.parquet(str(tmp_path / "compact"))
    expected = {}
    for c in range(30):
        text, n = "", 0
        for _, _, role, said in sorted(r for r in rows if r[0] == c):
            said = re.sub(C.CONTROL, r"\1\2\\\3", said)
            text += f"{C.START}{role}{C.SEPARATOR}"
            if role == "assistant":
                expected[c, n] = (text + said + C.END + "\n", len(text), len(text) + len(said))
                n += 1
            text += said + C.END + "\n"
    for examples in (C.expand_examples(compact), C.expand_examples(formatted, ordered=True)):
        found = {(r["conv_id"], r["example"]): (r["text"], r["loss_start"], r["loss_end"]) for r in examples.collect() if r["loss_start"] is not None}
        assert found == expected
    C.expand_examples(compact).repartition(5, "text").write.parquet(str(tmp_path / "examples"))
    again = C.read_back(spark.read.parquet(str(tmp_path / "examples"))).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, C.read_back(C.expand_examples(formatted)).collect()))
    with pytest.raises(Exception, match="without its context"):
        C.expand_examples(compact.filter("example != 0")).collect()


def test_escapes_can_be_undone(spark):
    rng = random.Random(7)
    atoms = ["<", "[", "\\", "|im_end|>", "/s>", "s>", "INST]", "/INST]", "x", "|im_sep|>", "\n"]
    texts = ["".join(rng.choice(atoms) for _ in range(rng.randint(0, 12))) for _ in range(500)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", C.escape(F.col("t")).alias("e")).collect()
    for r in rows:
        assert C.unescape(r["e"]) == r["t"] and not any(m in r["e"] for m in ("<|im_end|>", "</s>", "[INST]", "[/INST]", "<|im_sep|>"))


@pytest.mark.parametrize("wrapper", ['form action="/"', 'div class="content no-sidebar"', 'div id="page-header-fixed"', 'div class="post share-enabled"'])
@pytest.mark.parametrize("inner", ["article", "div"])
def test_wrappers_of_the_whole_page_stay(wrapper, inner):
    body = "".join(f"<p>Sentence {i} of the story that this page was written for.</p>" for i in range(8))
    menu = '<nav><a href="/">Home</a></nav><div class="sidebar"><p>Other things</p></div><button>Send</button>'
    text = main_text(f"<html><body><{wrapper}>{menu}<{inner}>{body}</{inner}></{wrapper.split()[0]}><div class='footer'>All rights</div></body></html>")
    assert all(f"Sentence {i} of" in text for i in range(8))
    assert not any(x in text for x in ("Home", "Other things", "Send", "All rights"))


PROBES = [
    ("<article><p data=it's>Hello</p><p>I don't know</p></article>", "Hello\nI don't know"),
    ('<article><p title="5" tall">Hello</p></article>', "Hello"),
    ('<article><p title="never closed>Hello</p><p>there</p></article>', "Hello\nthere"),
    ('<div class="post notice-board-article"><p>Real text of this page</p></div><div class="notice"><p>Not this</p></div>', "Real text of this page"),
    ("<article><header><h1>Title</h1></header><p>Text of it</p><footer>by me</footer></article><header>Site</header>", "Title\nText of it"),
    ("<form><div class=c><p>All of the page is in a form</p><input></div></form>", "All of the page is in a form"),
    ("<div class='site-header'><p>Home of it</p></div><div><p>The very text of this page</p><div class='ad-box'><p>Buy</p></div></div>", "The very text of this page"),
]


@pytest.mark.parametrize("page,text", PROBES)
def test_pages_keep_their_article(page, text):
    assert main_text(f"<html><body>{page}</body></html>") == text


def test_density_sums_against_brute_force():
    from cardlens.llm import html_text as H

    rng = random.Random(3)

    def tree(depth):
        """(markup, element) with element = [tag, children], text as (string, in a link)."""
        kids, out = [], ""
        for _ in range(rng.randint(1, 4)):
            kind = rng.random()
            if depth and kind < 0.5:
                tag = rng.choice(["div", "section", "article", "blockquote"])
                markup, inner = tree(depth - 1)
                out += f"<{tag}>{markup}</{tag}>"
                kids.append([tag, inner])
            elif kind < 0.75:
                word = "w" * rng.randint(1, 30)
                out += f"<a href=x>{word}</a>"
                kids += [["a", [(word, True)]]]
            else:
                word = "t" * rng.randint(1, 60)
                out += f"<b>{word}</b>"
                kids += [["b", [(word, False)]]]
        return out, kids

    def count(kids):
        chars = tags = link_chars = link_tags = 0
        for x in kids:
            if isinstance(x, tuple):
                chars, link_chars = chars + len(x[0]), link_chars + len(x[0]) * x[1]
            else:
                c, t, lc, lt = count(x[1])
                chars, tags, link_chars, link_tags = chars + c, tags + t + 1, link_chars + lc, link_tags + lt + (x[0] == "a")
        return chars, tags, link_chars, link_tags

    def density(kids, whole):
        c, t, lc, lt = count(kids)
        wc, _, wlc, _ = whole
        base = math.log(c / max(c - lc, 1) * lc + wlc / wc * c + math.e)
        if not lc:
            return c / max(t, 1) * (1 + math.log1p(c) / base)
        return c / max(t, 1) * max(math.log(max(c / lc * max(t, 1) / max(lt, 1), 1.0) + 1e-9) / base, 0.0)

    for _ in range(60):
        markup, kids = tree(4)
        root = H.parse(f"{markup}")
        order = H._measure(root)
        sums, whole, expected = H.density_sums(order), count(kids), []

        def walk(kids, weight, tag):
            blocks = [x for x in kids if not isinstance(x, tuple) and x[0] not in "ab"]
            own = sum(count([x])[0] for x in kids if not isinstance(x, tuple) and x[0] == "b")
            expected.append(weight * (own + sum(density(x[1], whole) for x in blocks)))
            for x in blocks:
                walk(x[1], weight * (H.ARTICLE if x[0] == "article" and tag != "article" else 1.0), x[0])

        walk(kids, 1.0, "html")
        assert [sums[id(n)] for n in order] == pytest.approx(expected)


def test_page_columns_that_clash(spark):
    rows = [(1, "a", "<p>x</p>", "old")] * 2
    got = extract_text(spark.createDataFrame(rows, "page_id long, _html string, html string, text string")).collect()
    assert [(r["_html"], r["text"]) for r in got] == [("a", "x")] * 2


def test_equally_dense_subtrees_and_long_pages():
    half = "<div><p>The same words in both</p><p>and once more so</p></div>"
    assert main_text(f"<body>{half}{half}</body>").startswith("The same words in both")
    assert len(main_text("<article>" + "<p>many words here</p>" * 60_000 + "</article>").split("\n")) == 60_000


def test_articles_stay_whole():
    """No class name, wrapper or strange element takes a part of an article; menus stay out."""
    from cardlens.llm.html_text import main_text

    words = "Words of a long paragraph go on here. " * 8
    p = f"<p>{words}</p>"

    def text(body):
        return main_text(f"<html><body>{body}</body></html>").replace(words.strip(), "[P]").split("\n")

    assert text(f"<div class=content><p>Lead.</p><div>{p}{p}</div><p>End.</p></div>") == ["Lead.", "[P]", "[P]", "End."]
    assert text(f"<main><section><h2>A</h2>{p * 3}</section><section><h2>B</h2><p>Short closing words of it.</p></section></main>") == ["A", "[P]", "[P]", "[P]", "B", "Short closing words of it."]
    for n in (1, 2, 4, 7):
        assert text("<article>" + f'<div class="widget">{p}</div>' * n + "</article>") == ["[P]"] * n
    assert text(f"<article><h1>T</h1><div class='reply-text'>{p * 3}</div></article>") == ["T", "[P]", "[P]", "[P]"]
    assert text(f"<article>{p}<p>One <svg><g>x</g></svg> goes <button>b</button>on <x-y>and</x-y> <picture><img></picture>on.</p></article>") == ["[P]", "One goes on and on."]
    assert text(f"<nav class=top/>Home Menu</nav><aside data-u=/x/>Side</aside><article>{p}<a href=/foo/>link</a></article>") == ["[P]", "link"]
    assert text(f"<article>{p}</article><div class=comments><p>{'c ' * 900}</p></div>") == ["[P]"]
    assert text(f"<article>{p}<div class=widget>Buy</div></article>") == ["[P]"]
