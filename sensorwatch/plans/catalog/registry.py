"""Catalogue of queries over the sample tables, each with an equivalent SQL text where one exists."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query: {name}")
        QUERIES[name] = build
        if sql:
            SQL[name] = sql
        return build

    return add


def rounded(value: Column | str) -> Column:
    """The nearest single-precision number, for comparison with another engine: both read the same
    value unless their sums differ by far more than the order of addition explains."""
    value = F.col(value) if isinstance(value, str) else value
    return value.cast("float").cast("double")
