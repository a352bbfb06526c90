"""Facts and cohorts laid out by the year of their event.

A laid-out relation is a parquet folder with one subfolder a year. A window then
prunes whole years before any file is opened, which the closed bounds on the time
itself cannot do where files mix years; the bounds stay, and settle the rows of the
first and last year. Rows without a time lie in a subfolder of their own and are
read by no window.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.functions.predicates import between_closed
from tallyward.params import Window
from tallyward.sources.tables import SourceTables

YEAR = "EventYear"

TIMES = {
    "outpat_workload": "VisitDateTime",
    "inpat_inpatient": "AdmitDateTime",
    "oncology_primary": "DateDX",
    "edis_edislog": "PatientArrivalDateTime",
}
"""The facts that have a time, and which."""


def write_by_year(df: DataFrame, target: str, time: str) -> None:
    """Replace a folder with the rows by year.

    Rows are dealt out by year before they are written, so that a year is few
    files; a year with a large share of the rows is split (Spark rebalances it).
    """
    dealt = df.withColumn(YEAR, F.year(time)).hint("rebalance", YEAR)
    dealt.write.mode("overwrite").partitionBy(YEAR).parquet(target)


def read_by_year(spark: SparkSession, target: str, like: DataFrame) -> DataFrame:
    """A laid-out relation with the columns of ``like`` and the year."""
    return spark.read.schema(like.withColumn(YEAR, F.lit(None).cast("int")).schema).parquet(target)


def in_window(fact: DataFrame, time: str, window: Window) -> DataFrame:
    """Rows of the closed window; of a laid-out relation only the window's years are read."""
    rows = fact.filter(between_closed(time, *window))
    return rows.filter(F.col(YEAR).between(F.year(window.start), F.year(window.end))) if YEAR in fact.columns else rows


def in_years(fact: DataFrame, years: DataFrame, year: str = YEAR) -> DataFrame:
    """Rows of a laid-out relation of the years in a relation, which are known when the query runs.

    The join is on the folders' column, so Spark prunes folders by what the other
    side turns out to hold.
    """
    return fact.join(years.select(F.col(year).cast("int").alias(YEAR)).distinct(), YEAR, "left_semi").select(*fact.columns)


def lay_out(tables: SourceTables, folder: str, times: Mapping[str, str] = TIMES) -> SourceTables:
    """The same tables with the facts that have a time laid out by year under ``folder``."""
    laid = {}
    for name, df in vars(tables).items():
        if name in times:
            target = f"{folder}/{name}"
            write_by_year(df, target, times[name])
            df = read_by_year(df.sparkSession, target, df)
        laid[name] = df
    return SourceTables(**laid)


def laid_out(spark: SparkSession, folder: str, tables: SourceTables, times: Mapping[str, str] = TIMES) -> SourceTables:
    """Tables whose facts were laid out before by :func:`lay_out`."""
    return SourceTables(**{
        name: read_by_year(spark, f"{folder}/{name}", df) if name in times else df for name, df in vars(tables).items()})


def years_of(*bounds: Column) -> Column:
    """All years from the first bound's to the last one's."""
    return F.sequence(F.year(bounds[0]), F.year(bounds[-1]))
