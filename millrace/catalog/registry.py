"""The registered queries: a name, a Spark callable and, where SQL can say it, a check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        key = name or function.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = function
        if sql is not None:
            CHECKS[key] = sql
        return function

    return register


def rounded(column: str | Column, digits: int = 6) -> Column:
    """Rounded for comparison; adding zero turns -0.0 into 0.0."""
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column.cast("double"), digits) + F.lit(0.0)


def round_all(df: DataFrame, names: list[str], digits: int = 6) -> DataFrame:
    return df.select(*[
        rounded(c, digits).alias(c) if c in names else F.col(c) for c in df.columns
    ])
