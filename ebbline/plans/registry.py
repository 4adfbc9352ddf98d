"""Registry of named queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Added before rounding on both sides, so that values lying exactly between two
# rounded ones do not flip with the order in which an engine sums.
NUDGE = "0.00000033"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def rounded(df: DataFrame, digits: Mapping[str, int] | None = None, default: int = 4) -> DataFrame:
    """Round every double column for comparison with the SQL side."""
    digits = digits or {}
    return df.select(
        *[
            F.round(F.col(c) + F.lit(float(NUDGE)), digits.get(c, default)).alias(c) if t == "double" else F.col(c)
            for c, t in df.dtypes
        ]
    )


def r(expr: str, name: str | None = None, digits: int = 4) -> str:
    """SQL twin of :func:`rounded` for one column."""
    return f"round(({expr}) + {NUDGE}, {digits}) AS {name or expr}"
