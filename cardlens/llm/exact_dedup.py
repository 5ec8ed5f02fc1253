"""Exact dedup by a tree-merge of sorted digest runs.

Every text becomes a SHA-256 digest. A row's lane (a hash of its identifier) says which run it
starts in, so a group of copies, however large, is spread over all lanes. Rounds are binomial:
in each, the runs of ``fan_in`` neighbouring lanes (two) meet. A shuffle deals them out by (lane
pair, digest), Spark brings the runs of a partition into one order, and a streaming merge compares whole
digests and keeps one entry of each, with the best identifier so far and the number of rows
behind it. After log2(lanes) rounds there is one entry per digest. Answers go back by (lane, digest), so no join key ever
holds more than one lane's share of a group.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.llm.common import checkpoint, numbered

LANES = 64
FAN_IN = 2
_RUN = "lane int, digest binary, best_id long, best_row long, n long"


def _merge_runs(keep_largest: bool):
    """Merge entries of equal (lane, digest) that follow one another in a sorted stream.

    Digests are compared over all 32 bytes; an entry whose digest differs is never merged. Only
    the last open entry is held between batches.
    """

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            schema = batch.schema
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            if not table.num_rows:
                continue
            lane = table["lane"].to_numpy()
            digest = np.array(table["digest"].to_pylist(), dtype="V32")
            starts = np.flatnonzero(np.r_[True, (lane[1:] != lane[:-1]) | (digest[1:] != digest[:-1])])
            # rows arrive with the best identifier of each digest first within a run of equals
            best_id, best_row = table["best_id"].to_pylist(), table["best_row"].to_numpy()
            ids = np.array([-(2**63) if x is None else x for x in best_id], dtype=np.int64)
            known = np.array([x is not None for x in best_id])
            group = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(lane)]))
            order = np.lexsort((best_row, ids if keep_largest else -ids, known, group))
            last = np.r_[starts[1:], len(lane)] - 1  # the best of each group is its last in order
            pick = pa.array(order[last])
            out = table.take(pick).set_column(4, "n", pa.array(np.add.reduceat(table["n"].to_numpy(), starts))).cast(schema)
            held = out.slice(len(starts) - 1, 1)
            yield from out.slice(0, len(starts) - 1).to_batches()
        if held is not None:
            yield from held.to_batches()

    return merge


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest", lanes: int = LANES, fan_in: int = FAN_IN, row_col: str | None = None
) -> DataFrame:
    """One row per row of ``docs``: row_uid, id, keep_id, group_size, kept, text_sha256.

    ``row_uid`` is ``row_col``, or numbers the rows as they are read. Texts
    are equal when identical; null counts as the empty text. ``keep`` is "largest" or "smallest"
    identifier; a null identifier loses against any other. Of rows that repeat an identifier and
    a text exactly one is kept. An empty table gives an empty result; other columns are ignored.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is largest or smallest")
    base = checkpoint(
        docs.select(
            (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row_uid"),
            F.col(id_col).cast("long").alias("id"),
            F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("digest"),
        ).withColumn("lane", F.pmod(F.xxhash64("row_uid"), F.lit(lanes)).cast("int"))
    )
    merge = _merge_runs(keep == "largest")

    def merged(runs: DataFrame) -> DataFrame:
        return runs.repartition("lane", "digest").sortWithinPartitions("lane", "digest").mapInArrow(merge, _RUN)

    first = merged(base.select("lane", "digest", F.col("id").alias("best_id"), F.col("row_uid").alias("best_row"), F.lit(1).cast("long").alias("n")))
    first = checkpoint(first)
    runs, width = first, lanes
    while width > 1:
        width = -(-width // fan_in)
        runs = merged(runs.withColumn("lane", F.floor(F.col("lane") / fan_in).cast("int")))
    answers = runs.select("digest", F.col("best_id").alias("keep_id"), F.col("best_row").alias("keep_row"), F.col("n").alias("group_size"))
    answers = first.select("lane", "digest").join(answers, "digest")
    return base.join(answers, ["lane", "digest"]).select(
        "row_uid", "id", "keep_id", "group_size", (F.col("row_uid") == F.col("keep_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept; nulls count as empty,
    of rows alike in identifier and text one stays."""
    rows, uid = numbered(docs)
    kept = exact_dedup(rows, id_col, text_col, keep, row_col=uid).filter("kept").select(F.col("row_uid").alias(uid))
    return rows.join(kept, uid, "left_semi").drop(uid)
