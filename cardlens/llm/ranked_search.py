"""Ranked lexical search by the best position algorithm.

Documents are dealt to shards of bounded size where they lie. In a shard every query term has an
impact list, its documents by falling impact. A query reads its lists from the top; each document
it meets is looked up directly in all other lists, which marks the document's position there as
seen, too. A list's best position is the end of its contiguous stretch of seen positions. No
unseen document can score more than the impacts at the best positions add up to, so a shard is
left once that sum is strictly below the k-th score so far (an equal score could still win by its
identifier). What a task keeps from one shard sets the bar for its next. The best k of every task
are merged by lanes, then as a whole.

Scores are exact integers: all statistics are of all documents, and the best k are those of a
full sort by (score, identifier).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardlens.llm.common import checkpoint

#: Terms in lower-cased UTF-8: letters and digits of ASCII, and all bytes of other code points.
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
#: A block of queries is closed at so many queries, or terms with repeats.
BLOCK_ITEMS, BLOCK_TERMS = 1024, 1 << 16
#: Cells of a shard's table of impacts, four bytes each.
CELLS = 12 << 20
LANES = 64


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8; only A-Z are lower-cased (what ``bytes.lower`` does)."""
    return _TERM.findall(text.lower()) if text else []


def term_weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _postings(vocabulary: dict[bytes, int]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, length, terms, times, cuts = [], [], [], [], [0]
            for i, text in enumerate(batch.column("text").cast(pa.binary())):
                found = terms_of(text.as_py())
                if not found:
                    continue
                ids.append(i)
                length.append(len(found))
                for word, tf in Counter(found).items():
                    t = vocabulary.get(word)
                    if t is not None:
                        terms.append(t)
                        times.append(tf)
                cuts.append(len(terms))
            cuts = pa.array(cuts, pa.int32())
            lists = [pa.ListArray.from_arrays(cuts, pa.array(x, pa.int32())) for x in (terms, times)]
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(ids, pa.int64())), pa.array(length, pa.int64()), *lists], ["id", "n", "terms", "times"])

    return run


def best_positions(lists: list[np.ndarray], impacts: np.ndarray, ids: np.ndarray, best: tuple[np.ndarray, np.ndarray], k: int) -> tuple[tuple[np.ndarray, np.ndarray], int]:
    """One query in one shard: the best (scores, ids) after it, and how many documents were looked up.

    ``lists[t]`` holds the shard's documents with term t by falling ``impacts[t]`` (weighted, one
    column a document); ``best`` is what earlier shards gave.
    """
    seen = np.zeros(impacts.shape[1], bool)
    at = [0] * len(lists)
    scores, names = best
    step, looked = 16, 0
    while True:
        front = [lst[a : a + step] for lst, a in zip(lists, at) if a < len(lst)]
        if not front:
            break
        new = np.unique(np.concatenate(front))
        new = new[~seen[new]]
        seen[new] = True
        looked += len(new)
        scores = np.concatenate([scores, impacts[:, new].sum(0)])  # direct accesses to every list
        names = np.concatenate([names, ids[new]])
        order = np.lexsort((names, -scores))[:k]
        scores, names = scores[order], names[order]
        bar = 0
        for t, lst in enumerate(lists):
            a = at[t]
            while a < len(lst):
                known = seen[lst[a : a + 4 * step]]
                unseen = int(known.argmin())
                if not known[unseen]:
                    a += unseen
                    bar += int(impacts[t, lst[a]])
                    break
                a += len(known)
            at[t] = a
        if len(scores) >= k and bar < scores[-1]:
            break
        step *= 2
    return (scores, names), looked


def _search(queries: list[tuple[np.ndarray, np.ndarray]], terms: int, documents: int, total: int, k: int):
    """queries: of each the term numbers and their weights, all above 0."""
    shard = max(CELLS // max(terms, 1), 64)

    def rank(ids: list, length: list, found: list, times: list, best: list) -> None:
        n = np.concatenate(length)
        per_doc = np.concatenate([np.diff(c) for c, _ in found])
        term = np.concatenate([v for _, v in found])
        tf = np.concatenate(times).astype(np.int64)
        doc = np.repeat(np.arange(len(n)), per_doc)
        m = 75 + 25 * n * documents // total
        value = 1_000_000_000 * tf // (1000 * tf + 12 * m[doc])
        table = np.zeros((terms, len(n)), np.int32)
        table[term, doc] = value
        names = np.concatenate(ids)
        order = np.lexsort((doc, -value, term))
        order = order[value[order] > 0]
        begin = np.searchsorted(term[order], np.arange(terms + 1))
        listed = doc[order]
        for q, (own, weights) in enumerate(queries):
            lists = [listed[begin[t] : begin[t + 1]] for t in own]
            best[q] = best_positions(lists, weights[:, None] * table[own], names, best[q], k)[0]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = np.empty(0, np.int64)
        best = [(empty, empty)] * len(queries)
        held: list[list] = [[], [], [], []]
        size = 0

        def flush() -> None:
            nonlocal held, size
            if size:
                rank(*held, best)
            held, size = [[], [], [], []], 0

        for whole in batches:
            for begin in range(0, whole.num_rows, shard):
                batch = whole.slice(begin, shard)
                if size + batch.num_rows > shard:
                    flush()
                cuts = batch.column("terms").offsets.to_numpy()
                held[0].append(batch.column("id").fill_null(_NO_ID).to_numpy(zero_copy_only=False))
                held[1].append(batch.column("n").to_numpy())
                held[2].append((cuts, batch.column("terms").flatten().to_numpy()))
                held[3].append(batch.column("times").flatten().to_numpy())
                size += batch.num_rows
        flush()
        for q, (scores, names) in enumerate(best):
            if len(scores):
                ids = pa.array(names, mask=names == _NO_ID)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(scores), q, np.int32)), ids, pa.array(scores)], ["query", "doc_id", "score"])

    return run


#: Stands for a null identifier inside a task; the largest, so that nulls come last.
_NO_ID = np.iinfo(np.int64).max


def _blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """The queries in blocks; the driver holds one block at a time."""
    block, size = [], 0
    for row in items.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("binary").alias("t")).toLocalIterator():
        own = terms_of(bytes(row["t"]) if row["t"] is not None else None)
        if not own:
            continue
        block.append((row["i"], own))
        size += len(own)
        if len(block) >= BLOCK_ITEMS or size >= BLOCK_TERMS:
            yield block
            block, size = [], 0
    if block:
        yield block


def search(
    docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(item_id, rank, doc_id, score): of each row of ``items`` its ``k`` best rows of ``docs``.

    Equal scores rank by ascending identifier, null identifiers last; rows of equal identifier and
    score rank in any order. Null and empty texts have no terms: such documents count nowhere,
    such queries have no result, and so have queries none of whose terms occurs. Every row of
    ``items`` is a query of its own, even with a repeated or null id. Empty tables give an empty
    result, other columns are ignored, texts may have any length.

    Queries come in blocks (1,024 queries or 65,536 terms); each block reads the documents once
    and keeps of them what its terms need. A task holds one shard at a time.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = None
    for block in _blocks(items, item_id, item_text):
        result = _search_block(spark, rows, block, k)
        if result is not None:
            found = result if found is None else found.unionByName(result)
    return found if found is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")


def _search_block(spark: SparkSession, rows: DataFrame, block: list[tuple[int | None, list[bytes]]], k: int) -> DataFrame | None:
    vocabulary: dict[bytes, int] = {}
    for _, own in block:
        for word in own:
            vocabulary.setdefault(word, len(vocabulary))
    postings = checkpoint(rows.mapInArrow(_postings(vocabulary), "id long, n long, terms array<int>, times array<int>"))
    documents, total = postings.agg(F.count("*"), F.sum("n")).first()
    if not documents:
        return None
    df = {r["t"]: r["count"] for r in postings.select(F.explode("terms").alias("t")).groupBy("t").count().collect()}  # one row a term of the block
    queries = []
    for _, own in block:
        times = Counter(vocabulary[w] for w in own)
        weight = {t: term_weight(documents, df[t]) * c for t, c in times.items() if t in df}
        kept = sorted(t for t, w in weight.items() if w > 0)
        queries.append((np.array(kept, np.int64), np.array([weight[t] for t in kept], np.int64)))
    best = postings.mapInArrow(_search(queries, len(vocabulary), documents, total, k), "query int, doc_id long, score long")
    best = best.withColumn("lane", F.pmod(F.xxhash64("doc_id"), F.lit(LANES)))
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    for keys in (("query", "lane"), ("query",)):
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)
    names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(block)], "query int, item_id long")  # a block's ids
    return best.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")


#: The same in SQL, for tables ``documents`` and ``benchmark``.
ORACLE = r"""
WITH lowered AS (SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
words AS (SELECT doc_id, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM lowered),
sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, whole GROUP BY term, docs),
asked AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
counted AS (SELECT item_id, term, count(*) AS times FROM asked GROUP BY ALL),
scored AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total)))) AS BIGINT) AS score
  FROM counted JOIN weights USING (term) JOIN tf USING (term) JOIN sizes USING (doc_id), whole GROUP BY item_id, doc_id),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 20
"""
