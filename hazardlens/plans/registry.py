"""Registry of runnable queries and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlens.plans.inputs import Inputs

Build = Callable[[Inputs], DataFrame]
_BUILDERS: dict[str, Build] = {}
_ORACLES: dict[str, str] = {}
_GIVEN: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a query. ``sql`` continues the shared CTE list of :mod:`hazardlens.plans.oracle`:
    it starts with SELECT, or with a comma and further CTEs."""
    def register(build: Build) -> Build:
        if name in _BUILDERS:
            raise ValueError(f"duplicate query {name}")
        _BUILDERS[name] = build
        if sql is not None:
            from hazardlens.plans.oracle import with_views
            _GIVEN[name], _ORACLES[name] = sql, with_views(sql)
        return build

    return register


def sql_of(name: str) -> str:
    """The counterpart that a query registered before continues the shared list with."""
    return _GIVEN[name]


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Both engines add doubles in their own order: compare averages at a fixed number of places."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), places) for c in columns})


def _load() -> None:
    from hazardlens.plans import (  # noqa: F401
        queries_explore, queries_feeds, queries_hub, queries_model, queries_rows, queries_streams,
    )


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def runner(build: Build) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: build(Inputs(spark, folder))

    return {name: runner(build) for name, build in sorted(_BUILDERS.items())}


def all_oracles() -> dict[str, str]:
    _load()
    return dict(sorted(_ORACLES.items()))
