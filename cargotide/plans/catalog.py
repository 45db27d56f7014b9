"""Registry of the queries over the given tables, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register under the SURVEY id and the operator's name."""
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return add


def r(c: str | Column, digits: int = 6) -> Column:
    """Rounded double without a negative zero, so both engines print the same value."""
    column = F.col(f"`{c}`") if isinstance(c, str) else c
    return F.round(column, digits) + F.lit(0.0)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: r(c, digits) for c in columns})


def load() -> tuple[dict[str, Query], dict[str, str]]:
    """All registered queries and oracles."""
    from . import (queries_calendar, queries_clean, queries_features, queries_forecast, queries_history, queries_jobs,  # noqa: F401
                   queries_panel, queries_scores, queries_series)
    return dict(QUERIES), dict(ORACLES)
