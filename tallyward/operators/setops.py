"""Set operations on event relations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from tallyward.functions.predicates import eq_tag
from tallyward.operators.joins import not_in


def union_events(*dfs: DataFrame) -> DataFrame:
    """Append; duplicates stay."""
    return reduce(DataFrame.unionByName, dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return union_events(*dfs).distinct()


def difference_by_key(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows of ``a`` whose key is not listed in ``b``, by the rules of NOT IN."""
    return not_in(a, b, key).distinct()


def prefer_source(df: DataFrame, person: str, tag: str, preferred: str) -> DataFrame:
    """Preferred-source rows, and other rows only of persons without one."""
    first = df.filter(eq_tag(tag, preferred))
    return union_distinct(first, not_in(df, first, person))
