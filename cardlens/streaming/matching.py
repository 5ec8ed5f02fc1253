"""The match loop: which URL of a log answers which query, with a deadline and a memory.

The log of a device holds three kinds of rows, in the order of (ms, seq): ``sent`` opens a query,
``line`` is a line of the log, ``body`` says what lay behind a URL (``print``: digest of its content, null if
it could not be fetched; ``complete``: whether it is a whole document). A query ends in one result:

    ready       the first new URL whose document is whole and has not been seen before
    incomplete  its document was not whole
    timeout     nothing came before the deadline; a body after it is too late
    replaced    the next query of the device was sent before

A URL is looked for in the line, then in the last 30 lines as one, so one that is split over lines waits
for its rest; a signed URL without its whole signature is none. URLs and documents that the device has had
before are passed over (remains of old queries). ``match_stream`` keeps that in state, ``match_table`` reads a
table in order; both run ``Loop``. State is bounded: 200 lines, and 10,000 URLs and documents of
which the newer 5,000 stay once there are more.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

# Lines kept and joined, URLs kept before and after compaction, the head of a log line, the shapes of a URL, its signature.
LINES_KEPT, LINES_JOINED, MOST_SEEN, SEEN_KEPT = 200, 30, 10_000, 5_000
HEAD = re.compile(r"^\d{2}-\d{2}\s+\d{2}:\d{2}:\d{2}\.\d{3}\s+\d+\s+\d+\s+\S+\s+[^:]+:\s*")
SHAPES = (r'"result"\s*:\s*"(https?://(?:\\.|[^"\\])*)"', r'result:\s*"?(https?://[^\s"]+)', r'(https?://[^\s"<>]+?\.md(?:\?[^\s"<>]*)?)')
SIGNED, SIGNATURE = "X-Amz-", re.compile(r"X-Amz-Signature=[0-9a-fA-F]{64}$")
CLOSERS = ")]}>,;'\"\\"

_SHAPES = [re.compile(s, re.I) for s in SHAPES]
RESULT = "device string, qid string, status string, url string, matched string, elapsed_ms long"
STATE = "qid string, started long, recent array<string>, pending array<string>, matched array<string>, seen array<string>, prints array<string>"


def _unescaped(text: str) -> str:
    """A URL as JSON strings write it (``\\/``, ``\\u0026``) in plain form."""
    try:
        return json.loads(f'"{text}"')
    except ValueError:
        return text.replace("\\/", "/")


def find_url(text: str) -> str | None:
    """The first whole URL of a markdown file in ``text``; one with part of a signature is passed over."""
    if "http" not in text.lower():
        return None
    for shape in _SHAPES:
        for m in shape.finditer(text):
            url = _unescaped(m.group(1)).rstrip(CLOSERS)
            if url.split("?")[0].split("#")[0].endswith(".md") and (SIGNED not in url or SIGNATURE.search(url)):
                return url
    return None


def _remember(known: list[str], index: set[str], x: str) -> None:
    known.append(x)
    index.add(x)
    if len(known) > MOST_SEEN:
        del known[:-SEEN_KEPT]
        index.intersection_update(known)


@dataclass
class Loop:
    """One device's loop. ``pending`` holds URLs whose body has not come, ``matched`` their text."""

    timeout: int
    qid: str | None = None
    started: int | None = None
    recent: list[str] = field(default_factory=list)
    pending: list[str] = field(default_factory=list)
    matched: list[str] = field(default_factory=list)
    seen: list[str] = field(default_factory=list)
    prints: list[str] = field(default_factory=list)

    def __post_init__(self) -> None:
        self._seen, self._prints = set(self.seen), set(self.prints)

    def close(self, status: str, ms: int, url: str | None = None, matched: str | None = None) -> tuple:
        out = (self.qid, status, url, matched, ms - self.started)
        self.qid, self.started, self.recent, self.pending, self.matched = None, None, [], [], []
        return out

    def expire(self) -> tuple:
        return self.close("timeout", self.started + self.timeout)

    def step(self, ms: int, kind: str, qid: str | None, text: str | None, print_: str | None, complete: bool) -> Iterator[tuple]:
        """Take a row; yield the results that it brings about."""
        if self.qid is not None and ms > self.started + self.timeout:
            yield self.expire()
        if kind == "sent":
            if self.qid is not None:
                yield self.close("replaced", ms)
            self.qid, self.started = qid, ms
        elif self.qid is None or text is None:
            return
        elif kind == "line":
            self._line(text)
        elif kind == "body" and text in self.pending:
            at = self.pending.index(text)
            matched = self.matched.pop(at)
            self.pending.pop(at)
            if print_ is None:
                return
            if not complete:
                yield self.close("incomplete", ms, text, matched)
            elif print_ not in self._prints:
                _remember(self.prints, self._prints, print_)
                yield self.close("ready", ms, text, matched)

    def _line(self, text: str) -> None:
        self.recent = [*self.recent[1 - LINES_KEPT :], text.rstrip("\r\n")]
        url, matched = find_url(text), text
        if url is None:
            window = self.recent[-LINES_JOINED:]
            url, matched = find_url("".join(HEAD.sub("", x).strip() for x in window)), "\n".join(window)
        if url is not None and url not in self._seen:
            _remember(self.seen, self._seen, url)
            self.pending.append(url)
            self.matched.append(matched)


def _rows(batch: pd.DataFrame) -> Iterator[tuple]:
    yield from batch[["ms", "kind", "qid", "text", "print", "complete"]].astype(object).where(batch.notna(), None).itertuples(index=False, name=None)


def _shaped(rows: DataFrame) -> DataFrame:
    """The columns that the loop reads. Rows without a device or a time are nobody's and are left out."""
    rows = rows.filter("device IS NOT NULL AND ts IS NOT NULL").withColumn("ms", F.unix_millis(F.col("ts").cast("timestamp")))
    return rows.select(F.col("device").cast("string").alias("device"), "ts", "ms", F.col("seq").cast("long").alias("seq"), "kind", F.col("qid").cast("string").alias("qid"), "text", "print", F.coalesce("complete", F.lit(False)).alias("complete"))


def match_table(rows: DataFrame, timeout_ms: int) -> DataFrame:
    """(device, qid, status, url, matched, elapsed_ms) of the queries in a table of
    (device, ts, seq, kind, qid, text, print, complete); ``text`` of a body row is its URL.

    Rows are dealt by device and read in order, one at a time; a task holds one loop. Queries that are
    open when a device's log ends run into their deadline. Other columns are ignored.
    """

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        device, loop, out = None, None, []
        for batch in batches:
            for name, row in zip(batch["device"], _rows(batch)):
                if name != device:
                    if loop is not None and loop.qid is not None:
                        out.append((device, *loop.expire()))
                    device, loop = name, Loop(timeout_ms)
                out += [(device, *r) for r in loop.step(*row)]
            yield pd.DataFrame(out, columns=_NAMES)
            out = []
        if loop is not None and loop.qid is not None:
            yield pd.DataFrame([(device, *loop.expire())], columns=_NAMES)

    ordered = _shaped(rows).drop("ts").repartition("device").sortWithinPartitions("device", "ms", "seq")
    return ordered.mapInPandas(run, RESULT)


_NAMES = [c.split()[0] for c in RESULT.split(", ")]


def match_stream(rows: DataFrame, timeout_ms: int, delay: str = "0 seconds") -> DataFrame:
    """``match_table`` of a stream. A device's rows come in order from one micro-batch to the next (within one
    they are sorted); a query whose device falls silent ends once the watermark, ``delay`` behind the latest row of
    any device, has passed its deadline."""

    def run(key: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        loop = Loop(timeout_ms, *(list(x) if isinstance(x, (list, tuple)) else x for x in state.get)) if state.exists else Loop(timeout_ms)
        out = []
        if state.hasTimedOut:
            if loop.qid is not None:
                out.append(loop.expire())
        else:
            for row in _rows(pd.concat(list(batches)).sort_values(["ms", "seq"], kind="stable")):
                out += loop.step(*row)
        state.update((loop.qid, loop.started, loop.recent, loop.pending, loop.matched, loop.seen, loop.prints))
        if loop.qid is not None:
            state.setTimeoutTimestamp(max(loop.started + timeout_ms, state.getCurrentWatermarkMs()) + 1)
        yield pd.DataFrame([(*key, *r) for r in out], columns=_NAMES)

    shaped = _shaped(rows.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay))
    return shaped.groupBy("device").applyInPandasWithState(run, RESULT, STATE, "append", GroupStateTimeout.EventTimeTimeout)
