"""Name -> query, and name -> the same question as plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from riskloom.functions.expr import col

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round floating columns, because sums differ in the last bits between engines."""
    return df.select(
        *[
            F.round(col(f.name), places).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else col(f.name)
            for f in df.schema
        ]
    )
