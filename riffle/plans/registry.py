"""Registry of driver queries: name -> (builder, oracle SQL).

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole driver tables.  The oracle is the same question written in plain SQL
(run by DuckDB in the correctness gate); ``None`` marks a query that SQL
cannot express, which then gets a rows-only check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import read_table

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}
IDS: dict[str, list[str]] = {}


def query(name: str, sql: str | None = None, ids: str = ""):
    """Register a query builder (and its oracle SQL) under ``name``.

    """
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        IDS[name] = ids.split()
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


class Tables:
    """Lazy accessor for the driver tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return read_table(self._spark, self._dir, name)
