"""Document fingerprints from closed syncmers.

A k-mer of code points is an anchor if the least of its inner s-mers lies at one of its two
edges. Whether it is depends on the k-mer alone, so a passage keeps its anchors wherever it
stands, which lets texts be matched by position. Every window of k - s k-mers holds an anchor, so
the gap from one anchor to the next fits in a byte. A fingerprint holds all anchors of a text in
order: gap and 32-bit hash of each. Likeness is exact on them: the share of anchors, repeats
counted, that two texts have in common.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.llm.common import checkpoint

K, S = 16, 5
#: Code points that are hashed at a time, whatever the lengths of the texts.
_CHUNK = 1 << 18
#: A slice of documents has about so many bytes of text, as long as MOST_SLICES are enough.
SLICE_BYTES = 64 << 20
#: Bounds the table of slices that is part of the plan.
MOST_SLICES = 1 << 14
_ENTRY = np.dtype([("gap", "u1"), ("hash", ">u4")])


def _mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: spreads every input bit over the word."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _by_doubling(x: np.ndarray, n: int, join) -> np.ndarray:
    """Of every run of ``n`` values, what ``join(left, right, width of right)`` makes of them."""
    done, width, part = None, 1, x
    held = 0
    while True:
        if n & width:
            done = part if done is None else join(done[: len(x) - held - width + 1], part[held : len(x) - width + 1], width)
            held += width
        width *= 2
        if width > n:
            return done[: len(x) - n + 1]
        part = join(part[: len(x) - width + 1], part[width // 2 : len(x) - width // 2 + 1], width // 2)


def _gram_hashes(points: np.ndarray, n: int) -> np.ndarray:
    """A polynomial hash of every run of ``n`` points, mixed."""
    power = [pow(0x9E3779B97F4A7C15, w, 1 << 64) for w in range(n + 1)]
    return _mix(_by_doubling(points, n, lambda a, b, w: a * np.uint64(power[w]) + b))


def batch_anchors(texts: list[str], k: int = K, s: int = S) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each text the (hash uint32, start) of its closed syncmers, in order.

    k - 1 fixed values that no text holds stand before and after each text, so that even a text
    of one code point has k k-mers, an anchor among them, and no k-mer spans two texts. Starts
    count from the first of those values. The empty text has no anchor. Ties count for both edges.
    """
    pad = np.arange(1, 2 * k - 1, dtype=np.uint64) + np.uint64(0x110000)
    codes = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4") for t in texts]
    parts, starts, at = [], [], 0
    for c in codes:
        starts.append(at)
        parts += [pad[: k - 1], c.astype(np.uint64), pad[k - 1 :]]
        at += len(c) + 2 * (k - 1)
    starts = np.array(starts, np.int64)
    points = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    hashes, places = [], []
    window = k - s + 1
    for begin in range(0, len(points) - k + 1, _CHUNK):
        part = points[begin : begin + _CHUNK + k - 1]
        inner = _gram_hashes(part, s)
        least = _by_doubling(inner, window, lambda a, b, w: np.minimum(a, b))
        edge = np.flatnonzero((least == inner[: len(least)]) | (least == inner[window - 1 :]))
        hashes.append((_gram_hashes(part, k)[edge] >> np.uint64(32)).astype(np.uint32))
        places.append(edge + begin)
    hashes = np.concatenate(hashes) if hashes else np.empty(0, np.uint32)
    places = np.concatenate(places) if places else np.empty(0, np.int64)
    cuts = np.searchsorted(places, starts).tolist() + [len(places)]
    out = []
    for j, c in enumerate(codes):
        a, b = cuts[j], cuts[j + 1]
        own = places[a:b] - starts[j]
        inside = own < len(c) + k - 1 if len(c) else np.zeros(b - a, bool)  # k-mers with a code point of the text
        out.append((hashes[a:b][inside], own[inside]))
    return out


def anchors(text: str, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """``batch_anchors`` of one text."""
    return batch_anchors([text], k, s)[0]


def encode(found: tuple[np.ndarray, np.ndarray]) -> str:
    """The fingerprint: of every anchor the gap to the one before and the hash, in base 64."""
    entries = np.empty(len(found[0]), _ENTRY)
    entries["gap"], entries["hash"] = np.diff(found[1], prepend=0), found[0]
    return base64.b64encode(entries.tobytes()).decode()


def decode(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of the anchors that a fingerprint holds."""
    entries = np.frombuffer(base64.b64decode(fingerprint), _ENTRY)
    return entries["hash"].astype(np.uint32), np.cumsum(entries["gap"], dtype=np.int64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Dice coefficient of two lists of anchor hashes, repeats counted; 1 for two empty texts."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    a, b = np.sort(a), np.sort(b)
    nth = np.arange(len(a)) - np.searchsorted(a, a)
    shared = (nth < np.searchsorted(b, a, side="right") - np.searchsorted(b, a)).sum()
    return float(2 * shared / (len(a) + len(b)))


def same_until(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], k: int = K) -> int:
    """Code points from the start up to which the anchors of two texts agree, place by place."""
    n = min(len(a[0]), len(b[0]))
    differs = np.flatnonzero((a[0][:n] != b[0][:n]) | (a[1][:n] != b[1][:n]))
    n = int(differs[0]) if len(differs) else n
    return int(a[1][n - 1]) + 1 if n else 0


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter (rounded down) replaced by as much of ``following``."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def document_anchors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, hashes array<long>, positions array<long>): every anchor of every text, for matching
    by position. Null counts as the empty text, without anchors."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [anchors(t.as_py() or "") for t in batch.column("text")]
            arrays = [pa.array([f[i].astype(np.int64) for f in found], pa.list_(pa.int64())) for i in range(2)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *arrays], ["id", "hashes", "positions"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, hashes array<long>, positions array<long>")


_RESULT = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, same_until long"
#: Texts that are fingerprinted together: about so many code points, one text at least.
_TOGETHER = 1 << 17


def _chain(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a slice in order; each is compared with the one after it. A guest row (the head of
    the next slice, or of all for the last) only follows. A few texts are held at a time."""
    names = [x.split()[0] for x in _RESULT.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
    last: tuple | None = None  # (slice, guest, id, text, anchors)

    def results(rows: list[tuple]) -> pa.RecordBatch | None:
        nonlocal last
        found = batch_anchors([r[3] for r in rows])
        chain = ([last] if last is not None else []) + [(*r, f) for r, f in zip(rows, found)]
        pairs = [(x, y) for x, y in zip(chain, chain[1:]) if x[0] == y[0] and not x[1]]
        changed = [edited(x[3], y[3]) for x, y in pairs]
        out = []
        for (x, y), text, other in zip(pairs, changed, batch_anchors(changed)):
            digest = hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
            out.append((x[2], len(x[3]), digest, encode(x[4]), encode(other), likeness(x[4][0], other[0]), likeness(x[4][0], y[4][0]), min(same_until(x[4], other), len(x[3]))))
        last = chain[-1]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names) if out else None

    for batch in batches:
        rows, size = [], 0
        columns = [batch.column(c) for c in ("slice", "guest", "id", "text")]
        for part, guest, i, text in zip(*(c.to_pylist() if j < 3 else c for j, c in enumerate(columns))):
            text = text.as_py()
            rows.append((part, guest, i, text))
            size += len(text)
            if size >= _TOGETHER:
                if (done := results(rows)) is not None:
                    yield done
                rows, size = [], 0
        if rows and (done := results(rows)) is not None:
            yield done


def fingerprint_edits(docs: DataFrame, slices: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document, its fingerprint, and those of its edited text and of the next document.

    Result: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    same_until (code points up to which the text's and the edited text's anchors agree in place).
    The next document is that of the next larger id (ties by a hash of the text, null ids first);
    after the last comes the first. A single row follows itself. Null texts count as empty; an
    empty table gives an empty result; other columns are ignored. A text of any length is one row
    and is hashed in pieces.

    Documents are dealt once, by (id, hash of the text), to slices of consecutive rows of about
    ``SLICE_BYTES``, a task each; rows that share an id, null too, are so dealt over many slices, unless their texts are
    equal as well. The head of each slice is also sent to the slice before as a guest, so no row is
    ever looked up elsewhere. Where slices begin comes from a table of ids and hashes.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    key = F.struct(F.col("id").isNotNull().alias("known"), F.coalesce("id", F.lit(0).cast("long")).alias("at"), F.xxhash64("text").alias("h"))
    keys = checkpoint(rows.select(key.alias("k"), F.octet_length("text").cast("long").alias("size")).select("k.*", "size"))
    size = keys.agg(F.sum("size")).first()[0]
    if size is None:
        return spark.createDataFrame([], _RESULT)
    slices = min(slices or max(-(-size // SLICE_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions"))), MOST_SLICES)
    ranged = keys.repartitionByRange(slices, "known", "at", "h").groupBy(F.spark_partition_id()).agg(F.min(F.struct("known", "at", "h")).alias("head"))
    heads = sorted({(r["head"]["known"], r["head"]["at"], r["head"]["h"]) for r in ranged.collect()})  # one row a slice
    n = len(heads)
    dealt = rows.withColumn("k", key).withColumn("slice", _slice_of(F.col("k"), heads))
    own = F.struct(F.col("slice").alias("slice"), F.lit(0).alias("guest"))
    before = F.struct(F.when(F.col("slice") == 0, n - 1).otherwise(F.col("slice") - 1).alias("slice"), F.lit(1).alias("guest"))
    sent = F.when(F.col("k") == F.get(_keys(heads), F.col("slice")), F.array(own, before)).otherwise(F.array(own))
    dealt = dealt.withColumn("to", F.explode(sent)).select("to.slice", "to.guest", "id", "text", F.col("k.h").alias("h"))
    dealt = dealt.repartitionById(n, "slice").sortWithinPartitions("slice", "guest", F.col("id").asc_nulls_first(), "h").drop("h")
    return dealt.mapInArrow(_chain, _RESULT)


def _keys(heads: list[tuple[bool, int, int]]) -> Column:
    """The heads as an array: one constant, parsed once when the plan is made."""
    text = ",".join(f'{{"known":{str(known).lower()},"at":{at},"h":{h}}}' for known, at, h in heads)
    return F.from_json(F.lit(f"[{text}]"), "array<struct<known:boolean,at:bigint,h:bigint>>")


def _slice_of(k: Column, heads: list[tuple[bool, int, int]]) -> Column:
    """Which slice ``k`` is of: the last head that is at most ``k``, found by every step-th head first."""
    step = max(int(len(heads) ** 0.5), 1)

    def at_most(part: Column) -> Column:
        return F.size(F.filter(part, lambda c: c <= k))

    coarse = F.greatest(at_most(_keys(heads[::step])) - 1, F.lit(0)) * step
    return F.greatest(coarse + at_most(F.slice(_keys(heads), coarse + 1, F.lit(step))) - 1, F.lit(0)).cast("int")
