"""Best-fit packing by minimum bin slack.

Documents become token ids, longer ones are cut, and the pieces are packed by their lengths
alone. Spark counts the pieces of each length, a table of at most ``capacity`` rows. Over it
runs minimum bin slack: a bitset subset-sum over the lengths still available finds the fullest
feasible combination for a bin, which is then removed. A combination stays the fullest while its
lengths last, so it is removed as often as they do, in one step. The resulting plan says which
ranks of which length go where; pieces get their rank within their length in a distributed way
(rank within a hash bucket plus the sizes of the buckets before) and look up their place.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardlens.llm.common import checkpoint

CAPACITY = 2048
#: Most words whose ids a Python worker remembers.
REMEMBERED = 1_000_000
_LETTERS = "a-zªµºß-öø-ÿ"
_DIGITS = "0-9²³¹¼½¾"
#: Of the tokenizer file's own split pattern, what Latin-1 text in lower case can match.
_LATIN_WORD = re.compile(rf"[{_LETTERS}]+|[{_DIGITS}]|'(?:s|t|re|ve|m|ll|d)|[^\s{_LETTERS}{_DIGITS}\x1c-\x1f]+|[\x1c-\x1f]")


#: The steps of the tokenizer file for which ``_LATIN_WORD`` is right.
_STEPS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}


class WordTokenizer:
    """Ids of any tokenizers file; with known steps before the model, remembered by word.

    If the file's normalizer and splitter are the known ones, Latin-1 text without special tokens
    is lower-cased and split here, since each word's ids depend on the word alone. Any other text,
    and every text of other files, goes through the library as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            steps = json.load(f)
        self.by_word = all(steps.get(k) == v for k, v in _STEPS.items()) and not steps.get("truncation") and steps["model"].get("dropout") is None
        self.model = self.full.model
        self.special = [t.content for t in self.full.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in plain]
        self.byte_char = {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(other)}}

    def _word(self, word: str) -> bytes:
        if not (word.isascii() and word.isprintable()):
            word = "".join(map(self.byte_char.__getitem__, word.encode()))
        return np.array([t.id for t in self.model.tokenize(word)], "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            simple = False
        else:
            simple = self.by_word and not any(s in text for s in self.special) and not re.search("[\x1c-\x1f]", text)
        if not simple:
            return np.array(self.full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        words = _LATIN_WORD.findall(text.lower())
        known = self.known
        found = list(map(known.get, words))
        if None in found:
            fresh: dict[str, bytes] = {}
            for i, b in enumerate(found):
                if b is None:
                    w = words[i]
                    b = fresh.get(w)
                    if b is None:
                        b = fresh[w] = self._word(w)
                    found[i] = b
            if len(known) < REMEMBERED:
                known.update(fresh)
        return b"".join(found)


_tokenizers: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def tokenized_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """(row_uid, id, piece, start, length, ids_crc32[, ids]): every text's ids and ``end_id``, cut
    into pieces of ``capacity`` where longer. Null counts as the empty text, a piece of one id."""
    fields = "row_uid long, id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(tokenizer)
        for batch in batches:
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column("text")):
                data = tok.ids(text.as_py() or "") + end
                for k, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int64))
            at = pa.array(row, pa.int64())
            out = [batch.column("row_uid").take(at), batch.column("id").take(at), pa.array(piece, pa.int32()), pa.array(start, pa.int64())]
            out += [pa.array(length, pa.int64()), pa.array(crc, pa.int64())] + ([pa.array(ids, pa.list_(pa.int64()))] if with_ids else [])
            yield pa.RecordBatch.from_arrays(out, ["row_uid", "id", "piece", "start", "length", "ids_crc32", "ids"][: len(out)])

    rows = docs.select(F.monotonically_increasing_id().alias("row_uid"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, fields)


def fullest_bins(counts: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Minimum bin slack over {length: pieces}: [([(length, times)...], bins)...].

    Of equally full combinations the one with the longest pieces is taken.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError("lengths must be from 1 to the capacity")
    plan: list[tuple[list[tuple[int, int]], int]] = []
    lengths = sorted(left)
    full = (1 << (capacity + 1)) - 1
    reach, usable, valid = [1], [], 0  # reach[i]: sums of the first i lengths, as bits
    while lengths:
        del reach[valid + 1 :], usable[valid:]
        for n in lengths[valid:]:
            most = min(left[n], capacity // n)
            bits, step, rest = reach[-1], 1, most
            while rest:
                take = min(step, rest)
                bits |= (bits << (n * take)) & full
                rest -= take
                step *= 2
            reach.append(bits)
            usable.append(most)
        room = reach[-1].bit_length() - 1
        chosen = []
        for i in range(len(lengths) - 1, -1, -1):
            n = lengths[i]
            times = min(usable[i], room // n)
            while not reach[i] >> (room - times * n) & 1:
                times -= 1
            if times:
                chosen.append((n, times))
                room -= times * n
        bins = min(left[n] // times for n, times in chosen)
        plan.append((chosen, bins))
        changed = len(lengths)
        for n, times in chosen:
            left[n] -= times * bins
            i = lengths.index(n)
            if min(left[n], capacity // n) != usable[i]:
                changed = min(changed, i)
        valid = changed
        if any(not left[n] for n, _ in chosen):
            lengths = [n for n in lengths if left[n]]
    return plan


def _places(plan: list[tuple[list[tuple[int, int]], int]]) -> dict[str, np.ndarray]:
    """The plan by length and rank: rank ranges with the first sequence, times a bin and offset."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for chosen, bins in plan:
        offset = 0
        for n, times in chosen:
            first = used.get(n, 0)
            rows.append(((n << 48) + first, first, sequence, times, offset))
            used[n] = first + times * bins
            offset += n * times
        sequence += bins
    rows.sort()
    return {k: np.array([r[i] for r in rows], np.int64) for i, k in enumerate(("key", "first", "sequence", "times", "offset"))}


def pack(pieces: DataFrame, capacity: int = CAPACITY, buckets: int = 1024) -> DataFrame:
    """``pieces`` (row_uid, id, piece, length, ...) with sequence_id and offset added.

    Only the length decides where a piece goes; pieces of equal length are ranked by a hash
    bucket of (row_uid, piece), then by id. An empty table gives an empty result.
    """
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    places = _places(fullest_bins(counts, capacity))
    buckets = max(buckets, sum(counts.values()) >> 16)
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64("row_uid", "piece"), F.lit(buckets)))
    sizes = dealt.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("length", "_bucket", before.alias("_before"))
    in_bucket = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("id", "row_uid", "piece")) - 1
    ranked = dealt.withColumn("_rank", in_bucket).join(sizes, ["length", "_bucket"]).withColumn("_rank", (F.col("_before") + F.col("_rank")).cast("long"))
    names = pieces.columns
    ranked = ranked.select(*names, "_rank")

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            at = np.searchsorted(places["key"], (n << 48) + rank, side="right") - 1
            nth = rank - places["first"][at]
            times = places["times"][at]
            out = [batch.column(c) for c in names]
            out += [pa.array(places["sequence"][at] + nth // times), pa.array(places["offset"][at] + nth % times * n)]
            yield pa.RecordBatch.from_arrays(out, [*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False, **columns: str) -> DataFrame:
    """Tokenize, cut and pack: row_uid, id, piece, start, length, ids_crc32[, ids], sequence_id,
    offset. Every row of ``docs`` gives at least one piece; repeated rows count one by one, null
    identifiers are carried, other columns ignored."""
    return pack(checkpoint(tokenized_pieces(docs, tokenizer, capacity, end_id, with_ids=with_ids, **columns)), capacity)
