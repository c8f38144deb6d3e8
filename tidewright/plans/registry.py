"""Named queries, each with the SQL that must give the same rows where there is one."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidewright.sources.tables import Tables

Build = Callable[[Tables], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Build
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a function from tables to a frame."""

    def add(build: Build) -> Build:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, build, sql)
        return build

    return add


_OPEN: dict[tuple[str, str], Tables] = {}


def tables(spark: SparkSession, folder: str) -> Tables:
    """The tables of a folder, opened once per session, so that their footers are not read for every query."""
    key = (spark.sparkContext.applicationId, folder.rstrip("/"))
    if key not in _OPEN:
        _OPEN[key] = Tables(spark, folder)
    return _OPEN[key]


def runner(q: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: q.build(tables(spark, folder))


def load_all() -> dict[str, Query]:
    """Import every module that registers queries."""
    from tidewright.plans import (  # noqa: F401
        audits,
        functions,
        ingestion,
        loads,
        models,
        monitoring,
        quality,
        relational,
        scans,
    )
    from tidewright.streaming import queries  # noqa: F401

    return REGISTRY
