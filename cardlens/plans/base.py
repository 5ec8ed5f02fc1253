"""Registration of queries and the SQL snippets that oracles share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its oracle if SQL can express it."""

    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def r(x: str, digits: int = 4) -> str:
    return f"(floor(({x}) * {10**digits} + 0.5e0) / {10**digits}.0e0)"


def gauss(x: str, mean: float, sigma: float) -> str:
    return f"greatest(0.0e0, least(100.0e0, 100.0e0 * exp(-(({x} - {mean}e0) * ({x} - {mean}e0)) / (2.0e0 * {sigma}e0 * {sigma}e0))))"


def band(x: str, lower: float, upper: float, low: float, high: float) -> str:
    return f"CASE WHEN {x} BETWEEN {lower}e0 AND {upper}e0 THEN 100.0e0 WHEN {x} < {lower}e0 THEN {gauss(x, lower, low)} ELSE {gauss(x, upper, high)} END"
