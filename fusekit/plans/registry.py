"""Named query plans: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name!r}")
        QUERIES[name] = fn
        return fn

    return register
