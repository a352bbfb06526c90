"""The query registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Build
    sql: str


REGISTRY: dict[str, Query] = {}


def query(sql: str, name: str | None = None) -> Callable[[Build], Build]:
    """Register a function, under its own name by default, with the SQL that checks it."""

    def register(build: Build) -> Build:
        REGISTRY[name or build.__name__] = Query(build, sql)
        return build

    return register


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")
