"""All named queries and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cardlens.plans import cards, evidence, fusion, geometry, static, streams, surfaces, text, trees  # noqa: F401  (they register their queries)
from cardlens.plans.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "flagship"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["fusion_overall"](spark, sf_dir)
