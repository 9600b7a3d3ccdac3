"""Registration of queries and their SQL twins, and helpers that make both sides comparable."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions.arrays import bind

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is the statement that must give the same rows."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def text(ids: Column | str) -> Column:
    """An integer array as one comma-separated value."""
    ids = F.col(ids) if isinstance(ids, str) else ids
    joined = F.array_join(ids.cast("array<string>"), ",")
    # a JSON array without its brackets is made without a string for each integer; only NULLs look otherwise
    inside = lambda json: F.when(F.contains(json, F.lit("null")), joined).otherwise(F.substring(json, F.lit(2), F.octet_length(json) - 2))
    return bind(F.to_json(ids), inside)


def r6(value: Column | str) -> Column:
    """Rounded for comparison across engines that sum in different orders."""
    return F.round(value, 6)
