"""The match loop against a plain one, and its stream against its table."""

import datetime
import random
import re

import pandas as pd

from cardlens.plans.base import QUERIES
from cardlens.plans import registry  # noqa: F401
from cardlens.sources.adapters import log_rows
from cardlens.streaming.harvest import read_stream, run_available
from cardlens.streaming.matching import HEAD, Loop, find_url, match_stream, match_table

SIG = "0123456789abcdef" * 4
URL = f"https://s.example/a.md?X-Amz-Signature={SIG}"
COLUMNS = "device string, ts timestamp, seq long, kind string, qid string, text string, print string, complete boolean"


def test_urls():
    assert find_url(f'x "result": "{URL}" y') == URL
    assert find_url(f"genWidgetResult result: {URL}, done") == URL
    assert find_url(r'"result":"https://s.example\/a.md?x=1\u0026y=2"') == "https://s.example/a.md?x=1&y=2"
    assert find_url("see (https://s.example/a.md), please") == "https://s.example/a.md"
    assert find_url(URL[:-1]) is None and find_url("https://s.example/a.txt") is None and find_url("") is None
    assert find_url(f"{URL[:-1]} then https://s.example/b.md") == "https://s.example/b.md"


def plain(rows, timeout):
    """One device, query by query: scan on from where the query was sent."""
    out, seen, prints, at = [], [], [], 0
    while at < len(rows):
        ms, kind, qid, *_ = rows[at]
        at += 1
        if kind != "sent":
            continue
        lines, waiting, result = [], {}, None
        while result is None:
            if at == len(rows) or rows[at][0] > ms + timeout:
                result = ("timeout", None, timeout)
            elif rows[at][1] == "sent":
                result = ("replaced", None, rows[at][0] - ms)
            else:
                t, kind, _, text, print_, complete = rows[at]
                at += 1
                if kind == "line":
                    lines.append(text)
                    url = find_url(text) or find_url("".join(re.sub(HEAD, "", x).strip() for x in lines[-30:]))
                    if url and url not in seen:
                        seen.append(url)
                        waiting[url] = text
                elif text in waiting:
                    del waiting[text]
                    if print_ and not complete:
                        result = ("incomplete", text, t - ms)
                    elif print_ and print_ not in prints:
                        prints.append(print_)
                        result = ("ready", text, t - ms)
        out.append((qid, *result))
    return out


def test_tables_logs_equal_the_plain_loop(spark):
    sf, timeout = "/root/testdata/sf0.01", 48 * 3_600_000
    rows = log_rows(spark, sf).toPandas().sort_values(["device", "ts", "seq"])
    want = []
    for device, r in rows.groupby("device"):
        ms = r["ts"].astype("datetime64[ms]").astype("int64")
        cells = [r[c].astype(object).where(r[c].notna(), None) for c in ("kind", "qid", "text", "print", "complete")]
        want += [(str(device), *x) for x in plain(list(zip(ms, *cells)), timeout)]
    got = QUERIES["match_loop"](spark, sf).collect()
    assert sorted((r.device, r.qid, r.status, r.url, r.elapsed_ms) for r in got) == sorted(want, key=lambda x: x[:2])
    assert {r.status for r in got} == {"ready", "incomplete", "timeout", "replaced"}


def test_a_split_url_waits_for_its_rest():
    loop = Loop(1000)
    steps = [(0, "sent", "a", None, None, False), (1, "line", None, f"result: {URL[:50]}", None, False), (2, "line", None, URL[50:] + " .", None, False), (3, "body", None, URL, "p", True)]
    assert [r for s in steps for r in loop.step(*s)] == [("a", "ready", URL, f"result: {URL[:50]}\n{URL[50:]} .", 3)]


def test_what_is_old_is_passed_over():
    loop = Loop(1000)

    def ask(q, at, *urls):
        rows = [(at, "sent", q, None, None, False)]
        for i, (u, p) in enumerate(urls):
            rows += [(at + i, "line", None, u, None, False), (at + i, "body", None, u, p, True)]
        return [r[:3] for s in rows for r in loop.step(*s)]

    a, b, c = (f"https://s.example/{x}.md" for x in "abc")
    assert ask("1", 0, (a, "pa")) == [("1", "ready", a)]
    assert ask("2", 10, (a, "pa"), (b, "pa"), (c, None)) == []
    assert ask("3", 5000, (c, "pc"), ("https://s.example/d.md", "pd")) == [("2", "timeout", None), ("3", "ready", "https://s.example/d.md")]


def test_memory_is_bounded():
    loop = Loop(10**9)
    list(loop.step(0, "sent", "a", None, None, False))
    for i in range(10_001):
        list(loop.step(1, "line", None, f"https://s.example/{i}.md", None, False))
    assert len(loop.seen) == len(loop._seen) == 5000 and loop.seen[-1].endswith("/10000.md") and len(loop.recent) == 200


def test_nulls_and_empty(spark):
    assert match_table(spark.createDataFrame([], COLUMNS), 10).count() == 0
    ts = datetime.datetime(2024, 1, 1)
    rows = [("d", ts, 1, "sent", "q", None, None, None), ("d", ts, 2, "line", None, None, None, None), (None, ts, 1, "sent", "z", None, None, None), ("d", ts, 3, None, None, "x", None, None)]
    out = match_table(spark.createDataFrame(rows, COLUMNS).selectExpr("*", "1 AS elapsed_ms", "2 AS status"), 10).collect()
    assert [(r.qid, r.status, r.elapsed_ms) for r in out] == [("q", "timeout", 10)]


def test_stream_in_random_batches_equals_the_table(spark, tmp_path):
    """Cut at random places, the log gives what it gives whole; a last row far ahead moves the watermark."""
    rng = random.Random(5)
    rows = log_rows(spark, "/root/testdata/sf0.001").filter("device < 4").toPandas().sort_values(["ts", "seq"])
    last = rows["ts"].max()
    ends = pd.DataFrame([("end", last + pd.Timedelta(days=d), d, "line", None, None, None, False) for d in (9, 10)], columns=rows.columns)
    rows = pd.concat([rows.assign(device=rows["device"].astype(str)), ends], ignore_index=True)
    cuts = sorted(rng.sample(range(1, len(rows) - 2), 3)) + [len(rows) - 1, len(rows)]
    start = 0
    for i, end in enumerate(cuts):
        part = rows.iloc[start:end].astype(object).where(rows.iloc[start:end].notna(), None)
        spark.createDataFrame([(r[0], r[1].to_pydatetime(), *r[2:]) for r in part.itertuples(index=False)], COLUMNS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / f"{i:03d}"))
        start = end
    whole = spark.read.schema(COLUMNS).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    stream = read_stream(spark, str(tmp_path / "in"), whole.schema, files_each=1)
    run_available(match_stream(stream, 48 * 3_600_000), str(tmp_path / "out"))
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == sorted(tuple(r) for r in match_table(whole, 48 * 3_600_000).collect()) and got
