"""Named queries: a builder ``(spark, sf_dir) -> DataFrame`` and the equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Build] = {}
ORACLES: dict[str, str] = {}


def query(sql: str) -> Callable[[Build], Build]:
    """Register the decorated builder under its function name."""

    def register(build: Build) -> Build:
        QUERIES[build.__name__] = build
        ORACLES[build.__name__] = sql
        return build

    return register
