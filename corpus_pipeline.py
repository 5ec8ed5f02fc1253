"""From raw documents to packed sequences, in five stages.

Each stage takes the rows that its predecessor kept, as a scan of a written table, and returns
the columns of ``documents`` (the last one: the packed pieces).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.llm.common import checkpoint
from cardlens.llm.exact_dedup import drop_copies
from cardlens.llm.language_id import keep_identified
from cardlens.llm.mixing import take_mix
from cardlens.llm.packing import pack_documents
from cardlens.llm.queries import tokenizer_path
from cardlens.llm.simhash import drop_near_copies


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose language is found."""
    return keep_identified(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that with the smallest doc_id."""
    return drop_copies(docs, keep="smallest")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity 0.8."""
    return drop_near_copies(docs, words=5, similarity=0.8)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return take_mix(docs, weights=(5, 2, 1), share=1.5, cap=2.0)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 2048."""
    pieces = pack_documents(docs, tokenizer_path(), capacity=2048, end_id=0)
    return pieces.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language_id", identified),
    ("exact_dedup", without_copies),
    ("simhash_near_dedup", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

#: Language models, fingerprints and random rounding are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = checkpoint(docs)
    return docs
