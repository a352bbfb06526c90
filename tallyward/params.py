"""Study parameters and the three windows that follow from them."""

from __future__ import annotations

from dataclasses import astuple, dataclass
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.functions.dates import dateadd
from tallyward.schemas import STUDY_PARAMS


@dataclass(frozen=True)
class StudyParams:
    """Defaults are the study's published values (fixed values)."""

    search_start: datetime = datetime(2019, 1, 1)
    search_length_months: int = 12
    exclude_length_years: int = -50
    lookback_length_days: int = -30
    carehx_length_months: int = 24


class Window(NamedTuple):
    """A closed time window; both ends belong to it."""

    start: Column
    end: Column


class Windows(NamedTuple):
    search: Window
    washout: Window
    emergency: Window


def params_df(spark: SparkSession, params: StudyParams, start: Column | None = None) -> DataFrame:
    """The parameter row; ``start``, such as a scalar subquery, replaces the search start."""
    values = [F.lit(value) for value in astuple(params)]
    if start is not None:
        values[0] = start
    return spark.range(1).select(
        *(value.cast(field.dataType).alias(field.name) for value, field in zip(values, STUDY_PARAMS, strict=True))
    )


def windows_of_row() -> Windows:
    """The windows as expressions over the columns of a parameter row."""
    start = F.col("Search_Start")
    end = dateadd("MONTH", F.col("Search_Length_Months"), start)
    return Windows(
        search=Window(start, end),
        washout=Window(dateadd("YEAR", F.col("Exclude_Length_Years"), start), start),
        emergency=Window(dateadd("DAY", F.col("Lookback_Length_Days"), start), end),
    )


def windows(params: StudyParams, start: Column | None = None) -> Windows:
    """The search, washout and emergency windows.

    The bounds are foldable literal expressions, so they reach the scans as
    pushed filters. ``start`` may be a column to anchor the windows per row.
    """
    if start is None:
        start = ntz_literal(params.search_start)
    end = dateadd("MONTH", params.search_length_months, start)
    return Windows(
        search=Window(start, end),
        washout=Window(dateadd("YEAR", params.exclude_length_years, start), start),
        emergency=Window(dateadd("DAY", params.lookback_length_days, start), end),
    )


def ntz_literal(value: datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
