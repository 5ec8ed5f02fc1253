"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.llm.common import checkpoint


#: A graph of at most so many links (two megabytes) is one task's work, without a shuffle.
FEW = 1 << 17


def _in_one_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root) of a few links, by union-find."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], ["node", "root"])


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    # the rows of a node meet its least neighbour in a join, not in a group
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the least of them (b < a here)."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    lower = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b")
    return lower.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with an edge; the root is the least node of its component.

    Each round is a few aggregations (with partial sums before the shuffle) and joins; rounds
    grow with the logarithm of the longest chain. The edge list goes to a checkpoint in every
    round and the driver sees one count and one checksum. At most ``FEW`` links are joined up in one task instead.
    """
    edges = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a > b").distinct()
    edges = checkpoint(edges)
    if edges.count() <= FEW:
        return checkpoint(edges.coalesce(1).mapInArrow(_in_one_task, "node long, root long"))
    seen = None
    while True:
        edges = checkpoint(_small_star(_large_star(edges)))
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
