"""Collects (query, SQL twin) pairs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.frames import Frames

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of :class:`Frames` under a name, with its SQL twin."""

    def wrap(build: Callable[[Frames], DataFrame]):
        QUERIES[name] = lambda spark, sf: build(Frames(spark, sf))
        if sql is not None:
            ORACLE[name] = sql
        return build

    return wrap
