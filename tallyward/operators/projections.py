"""Projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Keep the mapped columns under their new names, in the given order."""
    return df.select(*(F.col(old).alias(new) for old, new in mapping.items()))


def tag(df: DataFrame, **constants: str | int) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def with_star(df: DataFrame, **derived: Column) -> DataFrame:
    return df.select("*", *(expr.alias(name) for name, expr in derived.items()))


def distinct_project(df: DataFrame, *cols: str | Column) -> DataFrame:
    return df.select(*cols).distinct()
