"""SentencePiece BPE by vectorised merge rounds, and back.

Texts become words (a stretch of spaces and what follows it); a word's ids depend on the word
alone, so each is encoded once and remembered. New words of a batch are encoded together: one flat
array of symbols, beside it the rank of every symbol's pair with the next. A round takes the least
(rank, place) of every word, merges these pairs all at once, compacts the arrays and ranks the
pairs beside the merged symbols anew, until no word has a pair left. A word has one merge a round,
because a merge may form a pair that goes before the next equal one.

Words are first cut between characters that no piece holds side by side. What is still longer than
``LONG`` (a line of one repeated sign) would need as many rounds as it has characters and is merged
through a heap instead.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
LONG = 256
#: Most words whose ids a Python worker remembers, and the longest of them.
REMEMBERED, REMEMBERED_CHARS = 600_000, 64
#: Texts that are encoded together have about so many characters, one text at least.
_TOGETHER = 1 << 20
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_NONE = np.int64(2**62)
#: Symbols are numbered by piece id; characters that aren't pieces follow, by code point.
_CODES = 1 << 21


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            n = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, data[at : at + n]
            at += n


class PieceModel:
    """Pieces and merge ranks of a SentencePiece BPE model file.

    Models are taken that leave texts as they are but for spaces (identity normalizer, white space
    kept and escaped), with byte fallback and no pieces of the user; others raise ValueError.
    """

    def __init__(self, path: str):
        with open(path, "rb") as f:
            model = list(_fields(f.read()))
        pieces, kinds, scores = [], [], []
        trainer: dict[int, int | bytes] = {}
        normalizer: dict[int, int | bytes] = {}
        for field, value in model:
            if field == 1:
                own = dict(_fields(value))
                pieces.append(own[1].decode())
                scores.append(struct.unpack("<f", own.get(2, b"\0\0\0\0"))[0])
                kinds.append(own.get(3, _NORMAL))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                normalizer = dict(_fields(value))
        if trainer.get(3) != 2 or not trainer.get(35) or trainer.get(24):
            raise ValueError("a BPE model with byte fallback and leading spaces is needed")
        if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1):
            raise ValueError("a model that normalizes texts is not supported")
        if set(kinds) - {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}:
            raise ValueError("pieces of the user or unused ones are not supported")
        self.dummy = bool(normalizer.get(3, 1))
        self.end = trainer.get(42, 2)
        self.unknown = trainer.get(44, b" \xe2\x81\x87 ").decode()
        self.pieces, self.kinds = pieces, kinds
        normal = {p: i for i, p in enumerate(pieces) if kinds[i] == _NORMAL}
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in normal):
            raise ValueError("a piece holds a space behind a letter")
        self.byte_ids = np.zeros(256, np.int64)
        for i, p in enumerate(pieces):
            if kinds[i] == _BYTE:
                self.byte_ids[int(p[3:5], 16)] = i
        self.n = len(pieces)

        def symbol(part: str) -> int | None:
            return self.n + ord(part) if len(part) == 1 and part not in normal else normal.get(part)

        order = {s: r for r, s in enumerate(sorted({scores[i] for i in normal.values()}, reverse=True))}
        merges: dict[tuple[int, int], tuple[int, int]] = {}
        beside = set()
        for p, i in normal.items():
            beside.update(zip(p, p[1:]))
            for cut in range(1, len(p)):
                a, b = symbol(p[:cut]), symbol(p[cut:])
                if a is not None and b is not None:
                    merges[a, b] = (order[scores[i]], i)
        pairs = sorted((a * 2 * _CODES + b, r, i) for (a, b), (r, i) in merges.items())
        self.keys, self.ranks, self.results = (np.array([x[c] for x in pairs] or [0], np.int64) for c in range(3))
        self.beside = np.array(sorted(ord(a) * _CODES + ord(b) for a, b in beside) or [0], np.int64)
        self.code_symbols = np.arange(_CODES, dtype=np.int32) + self.n
        for p, i in normal.items():
            if len(p) == 1:
                self.code_symbols[ord(p)] = i
        line = "" if any("\n" in p for p in normal if len(p) > 1) else "\n"
        self.split = re.compile(f"{SPACE}+[^{SPACE}{line}]*|[^{SPACE}{line}]+" + (f"|{line}" if line else ""))
        self.known: dict[str, bytes] = {}
        surface = [p.replace(SPACE, " ").encode() if k == _NORMAL else b"" for p, k in zip(pieces, kinds)]
        self.surface = [self.unknown.encode() if k == _UNKNOWN else bytes([int(p[3:5], 16)]) if k == _BYTE else s for s, p, k in zip(surface, pieces, kinds)]

    @cached_property
    def merges(self) -> dict[tuple[int, int], tuple[int, int]]:
        """(rank, result) by pair; only the heap asks for it."""
        pairs = ((k // (2 * _CODES), k % (2 * _CODES)) for k in self.keys.tolist())
        return dict(zip(pairs, zip(self.ranks.tolist(), self.results.tolist())))

    # -- encoding

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left * (2 * _CODES) + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], _NONE), self.results[at]

    def _rounds(self, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge all segments (each begins at one of ``starts``): (symbols, segment of each)."""
        segment = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(symbols)]))
        rank = np.full(len(symbols), _NONE)
        merged = np.zeros(len(symbols), np.int64)

        def look(at: np.ndarray) -> None:
            """Rank the pairs that begin at ``at``."""
            inside = at[(at >= 0) & (at + 1 < len(symbols))]
            inside = inside[segment[inside] == segment[inside + 1]]
            rank[inside], merged[inside] = self._pair_ranks(symbols[inside], symbols[inside + 1])

        look(np.arange(len(symbols)))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            heads = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
            size = np.diff(np.r_[heads, len(symbols)])
            least = np.minimum.reduceat(rank, heads)
            open_ = least < _NONE
            if not open_.all():
                stay = np.repeat(open_, size)
                done.append((segment[~stay], symbols[~stay]))
                symbols, segment, rank, merged = symbols[stay], segment[stay], rank[stay], merged[stay]
                size, least = size[open_], least[open_]
                if not len(symbols):
                    break
                heads = np.cumsum(size) - size
            here = np.flatnonzero(rank == np.repeat(least, size))
            here = here[np.r_[True, segment[here][1:] != segment[here][:-1]]]  # the leftmost of each segment
            symbols[here] = merged[here]
            keep = np.ones(len(symbols), bool)
            keep[here + 1] = False
            symbols, segment, rank, merged = symbols[keep], segment[keep], rank[keep], merged[keep]
            here = here - np.arange(len(here))
            rank[here] = _NONE
            look(here)
            look(here - 1)
        where = np.concatenate([d[0] for d in done]) if done else np.empty(0, np.int64)
        order = np.argsort(where, kind="stable")
        return np.concatenate([d[1] for d in done])[order] if done else symbols, where[order]

    def _by_heap(self, symbols: np.ndarray) -> np.ndarray:
        """The same merges for one long segment, next pair first."""
        own = symbols.tolist()
        after, before = list(range(1, len(own))) + [-1], list(range(-1, len(own) - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] >= 0 and (found := self.merges.get((own[i], own[after[i]]))):
                heapq.heappush(heap, (found[0], i, own[i], own[after[i]]))

        for i in range(len(own)):
            offer(i)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if own[i] != left or j < 0 or own[j] != right:
                continue  # one of the two has been merged since
            own[i], own[j] = self.merges[left, right][1], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(i)
            offer(before[i])
        return np.array([s for s in own if s >= 0], np.int64)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word (no word may be empty) as little-endian 32-bit numbers."""
        if not words:
            return []
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        begins = np.cumsum([0] + [len(w) for w in words[:-1]])
        key = codes[:-1] * _CODES + codes[1:]
        at = np.minimum(np.searchsorted(self.beside, key), len(self.beside) - 1)
        cut = np.r_[True, self.beside[at] != key]
        cut[begins] = True
        starts = np.flatnonzero(cut)
        symbols = self.code_symbols[codes].astype(np.int64)
        sizes = np.diff(np.r_[starts, len(codes)])
        long = sizes > LONG
        short = np.repeat(~long, sizes)
        offsets = np.cumsum(sizes[~long]) - sizes[~long]
        merged, segment = self._rounds(symbols[short], offsets)
        place = np.flatnonzero(~long)[segment]
        if long.any():
            parts = [(k, self._by_heap(symbols[starts[k] : starts[k] + sizes[k]])) for k in np.flatnonzero(long)]
            place = np.concatenate([place, *(np.full(len(s), k) for k, s in parts)])
            merged = np.concatenate([merged, *(s for _, s in parts)])
            order = np.argsort(place, kind="stable")
            merged, place = merged[order], place[order]
        word = np.searchsorted(begins, starts[place], side="right") - 1
        strange = np.flatnonzero(merged >= self.n)
        if len(strange):  # characters that aren't pieces become their bytes
            raw = [self.byte_ids[list(chr(c).encode("utf-8", "surrogatepass"))] for c in (merged[strange] - self.n).tolist()]
            n = np.ones(len(merged), np.int64)
            n[strange] = [len(r) for r in raw]
            word, merged = np.repeat(word, n), np.repeat(merged, n)
            merged[merged >= self.n] = np.concatenate(raw)
        cuts = (4 * np.searchsorted(word, np.arange(len(words) + 1))).tolist()
        data = merged.astype("<i4").tobytes()
        return [data[a:b] for a, b in zip(cuts, cuts[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Of each text its ids as little-endian 32-bit numbers, without an end id."""
        found = []
        for t in texts:
            spaced = t.replace(" ", SPACE)
            found.append(self.split.findall(SPACE + spaced if self.dummy and t else spaced))
        known = self.known
        coded = [list(map(known.get, own)) for own in found]
        open_ = [i for i, ids in enumerate(coded) if None in ids]
        new = list({w: None for i in open_ for w, ids in zip(found[i], coded[i]) if ids is None})
        fresh = dict(zip(new, self.encode_words(new)))
        for i in open_:
            coded[i] = [fresh[w] if ids is None else ids for w, ids in zip(found[i], coded[i])]
        out = [b"".join(ids) for ids in coded]
        if len(known) < REMEMBERED:
            known.update((w, i) for w, i in fresh.items() if len(w) <= REMEMBERED_CHARS)
        return out

    # -- decoding

    def decode(self, ids: list[int]) -> str:
        """The text of any ids: control ids are silent, bytes that are no UTF-8 become U+FFFD each."""
        if ids and not 0 <= min(ids) <= max(ids) < self.n:
            raise ValueError("an id is not of this model")
        data = b"".join(map(self.surface.__getitem__, ids))
        first = next((i for i in ids if self.kinds[i] != _CONTROL), None)
        strip = self.dummy and first is not None and self.kinds[first] == _NORMAL and self.pieces[first].startswith(SPACE)
        try:
            text = data.decode()
        except UnicodeDecodeError:
            text = _lenient(data)
        return text[1:] if strip else text


def _lenient(data: bytes) -> str:
    """UTF-8 with a U+FFFD for every byte that belongs to no character."""
    out, at = [], 0
    while at < len(data):
        try:
            out.append(data[at:].decode())
            break
        except UnicodeDecodeError as e:
            out += [data[at : at + e.start].decode(), "�"]
            at += e.start + 1
    return "".join(out)


_models: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def encode_pieces(docs: DataFrame, model: str, end: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>): the ids of every whole text, and the model's end id where ``end``.

    Null counts as the empty text, which has no ids but the end. Repeated rows count one by one,
    null identifiers are carried, other columns ignored; an empty table gives an empty result. A
    text of any length is one row, in memory linear in it. ``model`` is a path that executors read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = piece_model(model)
        last = np.array([own.end], "<i4").tobytes() if end else b""
        for batch in batches:
            texts, size, begin = [], 0, 0
            column = batch.column("text")
            for i in range(batch.num_rows):
                texts.append(column[i].as_py() or "")
                size += len(texts[-1])
                if size >= _TOGETHER or i + 1 == batch.num_rows:
                    data = [ids + last for ids in own.encode(texts)]
                    cuts = pa.array(np.cumsum([0] + [len(d) // 4 for d in data]), pa.int32())
                    lists = pa.ListArray.from_arrays(cuts, pa.array(np.frombuffer(b"".join(data), "<i4")))
                    yield pa.RecordBatch.from_arrays([batch.column("id").slice(begin, len(texts)), lists], ["id", "ids"])
                    texts, size, begin = [], 0, i + 1

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, ids array<int>")


def decode_pieces(rows: DataFrame, model: str, ids_col: str = "ids", to: str = "text") -> DataFrame:
    """``rows`` with the text of ``ids_col`` (array<int>) added as ``to``; null ids give null.

    A null or foreign id inside an array raises. ``to`` replaces a column of that name.
    """
    others = [c for c in rows.columns if c.lower() != to.lower()]
    kept = rows.select(*(F.col(f"`{c}`") for c in others))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = piece_model(model)
        for batch in batches:
            lists = batch.column(ids_col)
            step = 256
            for begin in range(0, batch.num_rows, step):
                part = batch.slice(begin, step)
                texts = [own.decode(x.as_py()) if x.is_valid else None for x in lists.slice(begin, step)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*others, to])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(run, f"{schema}, `{to}` string")
