"""Named queries over the given tables, each with its SQL statement of the same result."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Build
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    def add(build: Build) -> Build:
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(name, build, sql)
        return build
    return add


def r6(c: Column | str) -> Column:
    """Doubles are compared to six decimals (costs to nine: they end before that)."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def load() -> dict[str, Query]:
    from winnowry.plans import (  # noqa: F401
        curation, evaluation, generation, logs, repositories, storage, streams, telemetry,
    )
    return REGISTRY
