"""Registry of queries: a function of (session, data folder) and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def rounded(column: Column | str, name: str) -> Column:
    """Six decimals, so that both engines print sums of doubles alike; never minus zero."""
    value = F.col(column) if isinstance(column, str) else column
    return F.when(F.abs(value) < 5e-7, F.lit(0.0)).otherwise(F.round(value, 6)).alias(name)


def rounded_sql(value: str) -> str:
    return f"CASE WHEN abs({value}) < 5e-7 THEN 0.0 ELSE round({value}, 6) END"
