"""First or last rows per key, ties kept.

The first (or last) time of each key is a hash aggregate, combined in every task
before the shuffle: nothing is sorted, and a key with a large share of the rows
sends one row a task. A semi join then fetches the rows at that time. Spark
broadcasts the times where they are few, so that the rows never travel; else it
shuffles both by key and time, and may split a hot key, since the times are one
row a key. The input is read twice, with its filters pushed both times; an
expensive one should be a stage, and :func:`first_times` may be one too.

Input that is sorted by key and time in its tasks already (a bucketed and sorted
table) is better ranked, which :func:`ranked_first` does in one pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def time_bounds(df: DataFrame, key: str, time: str, first: str = "first", last: str = "last") -> DataFrame:
    """Earliest and latest time per non-NULL key.

    A NULL time sorts before all others, so it leaves its key without an
    earliest time; the latest is unaffected.
    """
    has_null = F.bool_or(F.col(time).isNull())
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.when(~has_null, F.min(time)).alias(first),
            F.max(time).alias(last),
        )
    )


def first_times(df: DataFrame, key: str, time: str) -> DataFrame:
    """The earliest time of each non-NULL key; a NULL time comes first and leaves its key without."""
    has_null = F.bool_or(F.col(time).isNull())
    found = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.when(~has_null, F.min(time)).alias(time))
    return found.filter(F.col(time).isNotNull())


def last_times(df: DataFrame, key: str, time: str) -> DataFrame:
    """The latest time of each non-NULL key with any time."""
    found = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(time).alias(time))
    return found.filter(F.col(time).isNotNull())


def rows_at(df: DataFrame, times: DataFrame, key: str, time: str) -> DataFrame:
    """The rows at their key's time in ``times``, ties kept."""
    return df.join(times.select(key, time), [key, time], "left_semi").select(*df.columns)


def earliest_per_key(df: DataFrame, key: str, time: str) -> DataFrame:
    """A NULL time comes first, and leaves its key without an earliest row."""
    return rows_at(df, first_times(df, key, time), key, time)


def latest_per_key(df: DataFrame, key: str, time: str) -> DataFrame:
    return rows_at(df, last_times(df, key, time), key, time)


def ranked_first(df: DataFrame, key: str, time: str, *, last: bool = False) -> DataFrame:
    """The same by rank, for input that its tasks hold sorted by key and time.

    Only the first rank is kept, so each task drops the other rows before the
    shuffle; on unsorted input every task would first sort all it has.
    """
    order = F.col(time).desc_nulls_last() if last else F.col(time).asc_nulls_first()
    rank = F.rank().over(Window.partitionBy(key).orderBy(order))
    ranked = df.filter(F.col(key).isNotNull()).withColumn("_rank", rank)
    return ranked.filter(F.col("_rank") == 1).filter(F.col(time).isNotNull()).drop("_rank")
