"""Runs of words that repeat with a period, by minimizers of several scales.

A run is a stretch of words with smallest period q, at least twice q long, that cannot be extended
with that period. Periods below ``SHORT`` are found by comparing each word with the one a lag
before. For longer ones each scale, base 32, 64, 128 ..., finds periods of base to 2 * base - 1.
It picks in every window of base words the leftmost least hash of its base / 2 word grams. Inside
a run two windows a period apart hold the same words, so the same gram is picked twice, a period
apart: equal minimizers at such a distance seed all runs of the scale, and a seed is extended to
both sides as far as words agree at that lag.

Occurrences of one gram that overlap by half or more lie in a stretch of smaller period. They form
a cluster, an arithmetic progression. Two clusters give one seed for each distance between their
members, not one for each pair, so a scale has a number of seeds linear in the picked grams
however often a passage repeats.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.llm.fingerprint import _by_doubling, _mix

#: Periods below it are found by direct scans; a power of two, at least 8.
SHORT = 32
LEAST = 12
#: Documents are searched together up to about so many words, one at least.
_TOGETHER = 1 << 19
_BASE = 0x9E3779B97F4A7C15


def _stretches(x: np.ndarray, lag: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the longest stretches of x[i] == x[i + lag] of ``least`` places or more."""
    same = np.zeros(max(len(x) - lag, 0) + 2, np.int8)
    same[1:-1] = x[: max(len(x) - lag, 0)] == x[lag:]
    edges = np.flatnonzero(np.diff(same))
    start, end = edges[::2], edges[1::2]
    long = end - start >= least
    return start[long], end[long]


def _minimizers(values: np.ndarray, gram: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the grams, and the places of those that are the leftmost least of a window of grams."""
    power = [pow(_BASE, w, 1 << 64) for w in range(gram + 1)]
    hashes = _mix(_by_doubling(values, gram, lambda a, b, w: a * np.uint64(power[w]) + b))
    bits = np.uint64(max(len(values).bit_length(), 1))
    places = np.arange(len(hashes), dtype=np.uint64)
    ranked = hashes >> bits << bits | places
    least = _by_doubling(ranked, window, lambda a, b, w: np.minimum(a, b)) & ((np.uint64(1) << bits) - np.uint64(1))
    picked = least[np.r_[True, least[1:] != least[:-1]]] if len(least) else least
    return hashes, picked.astype(np.int64)


def _seeds(hashes: np.ndarray, picked: np.ndarray, gram: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag): equal picked grams, base to 2 * base - 1 apart, once for each distance of two clusters."""
    order = np.argsort(hashes[picked], kind="stable")
    at, key = picked[order], hashes[picked][order]
    gap = np.diff(at, prepend=0)
    opens = np.r_[True, key[1:] != key[:-1]]
    fresh = opens | (gap > gram // 2)
    heads = np.flatnonzero(fresh)
    first, last = at[heads], at[np.r_[heads[1:], len(at)] - 1]
    step = np.gcd.reduceat(np.where(fresh, 0, gap), heads)
    group = np.cumsum(opens)[heads]
    places, lags = [], []
    i, away = np.arange(len(heads)), 1
    while len(i):
        i = i[i + away < len(heads)]
        j = i + away
        near = (group[i] == group[j]) & (first[j] - last[i] < 2 * base)
        i, j = i[near], j[near]
        g = np.maximum(np.gcd(step[i], step[j]), 1)  # two single places have one distance, whatever g
        low = first[j] - last[i]
        low = low + np.maximum(-(-(base - low) // g), 0) * g
        high = np.minimum(last[j] - first[i], 2 * base - 1)
        n = np.maximum((high - low) // g + 1, 0)
        which = np.repeat(np.arange(len(i)), n)
        lag = low[which] + g[which] * (np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n))
        places.append(np.minimum(last[i][which], last[j][which] - lag))
        lags.append(lag)
        away += 1
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(places), np.concatenate(lags)


def _extended(x: np.ndarray, values: np.ndarray, place: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, lag) of the stretches x[i] == x[i + lag] round the seeds, each once, lag words long at least.

    Lengths come from hashes of prefixes by halving, and are compared word by word at the end.
    """
    n = len(x)
    power = np.multiply.accumulate(np.r_[np.uint64(1), np.full(n, _BASE, np.uint64)])
    total = np.r_[np.uint64(0), np.cumsum(values * power[:n], dtype=np.uint64)]

    def same(a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        return (total[a + length] - total[a]) * power[b - a] == total[b + length] - total[b]

    a, b = place, place + lag
    right, left = np.zeros_like(a), np.zeros_like(a)
    for bit in reversed(range(n.bit_length())):
        more = right + (1 << bit)
        fits = np.flatnonzero(b + more <= n)
        fits = fits[same(a[fits], b[fits], more[fits])]
        right[fits] = more[fits]
        more = left + (1 << bit)
        fits = np.flatnonzero(more <= a)
        fits = fits[same(a[fits] - more[fits], b[fits] - more[fits], more[fits])]
        left[fits] = more[fits]
    long = left + right >= lag
    found = np.unique(np.stack([(a - left)[long], (a + right)[long], lag[long]]), axis=1)
    start, end, lag = found
    right = [np.array_equal(x[s:e], x[s + q : e + q]) for s, e, q in zip(start.tolist(), end.tolist(), lag.tolist())]
    if not all(right):
        raise RuntimeError("two stretches of words share a 64-bit hash")
    return start, end, lag


def flat_runs(x: np.ndarray, bounds: np.ndarray, least: int = LEAST, short: int = SHORT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs in documents that lie one after the other in ``x``.

    Document d is x[bounds[d] : bounds[d + 1] - 1]; its last number occurs nowhere else, so that
    no run crosses it.
    """
    found = []
    for lag in range(1, short):
        start, end = _stretches(x, lag, max(least - lag, lag))
        found.append((start, end + lag, np.full(len(start), lag)))
    lengths = np.diff(bounds)
    base = short
    while True:
        lengths_ok = lengths > 2 * base
        if not lengths_ok.any():
            break
        where = np.flatnonzero(np.repeat(lengths_ok, lengths))
        part = x[where]
        values = _mix(part.astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(0x632BE59BD9B4E019))
        place, lag = _seeds(*_minimizers(values, base // 2, base // 2 + 1), base // 2, base)
        if len(place):
            start, end, lag = _extended(part, values, place, lag)
            found.append((where[start] if len(start) else start, where[end - 1] + 1 + lag if len(start) else end, lag))
        base *= 2
    start, end, period = (np.concatenate([f[c] for f in found]) for c in range(3))
    enough = end - start >= np.maximum(least, 2 * period)
    start, end, period = start[enough], end[enough], period[enough]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    smallest = np.r_[True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])][: len(start)]  # multiples of a period give the same stretch
    start, end, period = start[smallest], end[smallest], period[smallest]
    order = np.lexsort((period, start))
    return start[order], (end - start)[order], period[order]


def _search(words: list[list[bytes]], least: int, short: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of each list of words its runs."""
    number = count()
    ids = defaultdict(number.__next__)
    flat: list[int] = []
    bounds = [0]
    for own in words:
        flat.extend(map(ids.__getitem__, own))
        flat.append(next(number))
        bounds.append(len(flat))
    start, length, period = flat_runs(np.array(flat, np.int64), np.array(bounds), least, short)
    cuts = np.searchsorted(start, bounds)
    return [(start[a:b] - at, length[a:b], period[a:b]) for a, b, at in zip(cuts[:-1], cuts[1:], bounds)]


def collapse(words: list[bytes], runs: tuple[np.ndarray, np.ndarray, np.ndarray]) -> bytes:
    """The words joined by one space, without those that any run holds after its first period."""
    start, length, period = runs
    if not len(start):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    kept = np.cumsum(change)[:-1] == 0
    return b" ".join([words[i] for i in np.flatnonzero(kept).tolist()])


_RESULT = "id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def find_runs(
    docs: DataFrame,
    least: int = LEAST,
    short: int = SHORT,
    edit: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_words, runs, collapsed): every run of ``least`` words or more of each whole text.

    ``runs`` are (start, length, period) in order of start, then period; words are what ASCII white
    space separates, numbered from 0. ``collapsed`` keeps the first period of each run. ``edit``
    may change a document's words before the search. Null counts as the empty text (no runs,
    collapsed ''); repeated rows count one by one; null ids are carried; other columns are
    ignored; an empty table gives an empty result. A text of any length is one row, in memory
    linear in its words. Nothing is shuffled.
    """
    if short < 8 or short & (short - 1):
        raise ValueError("short is a power of two, at least 8")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_pylist()
            texts = batch.column("text").cast(pa.binary())
            words: list[list[bytes]] = []
            size = begin = 0
            for i, name in enumerate(ids):
                own = (texts[i].as_py() or b"").split()  # of bytes: at ASCII white space
                words.append(edit(name, own) if edit else own)
                size += len(words[-1])
                if size >= _TOGETHER or i + 1 == len(ids):
                    yield _rows(batch.column("id").slice(begin, len(words)), words, _search(words, least, short))
                    words, size, begin = [], 0, i + 1

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, _RESULT)


def _rows(ids: pa.Array, words: list[list[bytes]], runs: list[tuple]) -> pa.RecordBatch:
    cuts = pa.array(np.cumsum([0] + [len(r[0]) for r in runs]), pa.int32())
    fields = [pa.array(np.concatenate([r[c] for r in runs]).astype(np.int64)) for c in range(3)]
    found = pa.ListArray.from_arrays(cuts, pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
    collapsed = pa.array([collapse(w, r).decode("utf-8", "replace") for w, r in zip(words, runs)], pa.string())
    return pa.RecordBatch.from_arrays([ids, pa.array([len(w) for w in words], pa.int64()), found, collapsed], ["id", "n_words", "runs", "collapsed"])
