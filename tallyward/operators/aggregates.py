"""Exact counts. Each returns a DataFrame of one row, or one row per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.predicates import ci


def distinct_persons(df: DataFrame, key: str, name: str = "persons") -> DataFrame:
    return df.agg(F.count_distinct(key).alias(name))


def count_where(df: DataFrame, condition: Column, name: str = "n") -> DataFrame:
    return df.filter(condition).agg(F.count(F.lit(1)).alias(name))


def group_count_desc(
    df: DataFrame, col: str, name: str = "n", fold_case: bool = False
) -> DataFrame:
    """Rows per value (NULL is a group), largest first, then by value.

    ``fold_case`` groups spellings that differ in case or trailing blanks only
    and shows the first of them.
    """
    counted = F.count(F.lit(1)).alias(name)
    if fold_case:
        groups = df.groupBy(ci(col).alias("_group")).agg(counted, F.min(col).alias(col))
        groups = groups.drop("_group")
    else:
        groups = df.groupBy(col).agg(counted)
    return groups.select(name, col).orderBy(F.desc(name), F.asc_nulls_last(col))


def tagged_distinct(df: DataFrame, key: str, strata: dict[str, Column]) -> DataFrame:
    """Distinct (stratum, key) for every stratum a row belongs to, in one scan."""
    names = [F.when(condition, F.lit(name)) for name, condition in strata.items()]
    return (
        df.filter(F.col(key).isNotNull())
        .select(F.col(key).alias("_key"), F.explode(F.array_compact(F.array(*names))).alias("_stratum"))
        .distinct()
    )


def count_strata(tagged: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row with a count per stratum, 0 where a stratum is empty."""
    per_stratum = tagged.groupBy("_stratum").agg(F.count(F.lit(1)).alias("_n"))
    return per_stratum.agg(
        *(
            F.coalesce(F.sum(F.when(F.col("_stratum") == name, F.col("_n"))), F.lit(0).cast("bigint"))
            .alias(name)
            for name in names
        )
    )


def strata_distinct(df: DataFrame, key: str, strata: dict[str, Column]) -> DataFrame:
    """Distinct keys per stratum, all strata from one pass.

    Deduplicates (stratum, key) pairs and counts them, which shuffles each pair
    once; several COUNT(DISTINCT CASE ...) would copy every row per stratum
    into one global aggregate.
    """
    return count_strata(tagged_distinct(df, key, strata), list(strata))


def add_sums(df: DataFrame, sums: dict[str, Sequence[str]]) -> DataFrame:
    """Sums of counts. A key counted in two strata counts twice, as it should here."""
    totals = {name: sum((F.col(c) for c in cols[1:]), F.col(cols[0])) for name, cols in sums.items()}
    return df.withColumns(totals)
