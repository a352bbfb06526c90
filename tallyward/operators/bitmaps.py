"""Exact distinct counts that can be stored and merged.

Persons of a stratum are bits: a row per stratum and bucket of 32,768 person
numbers holds a bitmap, built by Spark's own aggregates in one pass, partial in
every task. Bitmaps of two periods unite bit by bit, so a new period is added, and
all are counted, without reading the rows of the old ones; plain counts could not
be added, since a person may be in both.

Numbers should lie close together, as surrogate keys do; :func:`numbered` gives
such numbers to persons known by any other key, and keeps those given before.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.operators.setops import union_events
from tallyward.sources.staging import stage


def strata_bitmaps(df: DataFrame, number: str, strata: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """``by``, stratum, bucket and bits; rows without a number, or in no stratum, leave no bit."""
    names = F.filter(
        F.array(*(F.when(condition, F.lit(name)) for name, condition in strata.items())), lambda name: name.isNotNull())
    rows = df.filter(F.col(number).isNotNull()).select(*by, F.col(number).cast("long").alias("number"), F.explode(names).alias("stratum"))
    return rows.groupBy(*by, "stratum", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def merged(*parts: DataFrame) -> DataFrame:
    """stratum, bucket and bits of all parts together."""
    rows = union_events(*(p.select("stratum", "bucket", "bits") for p in parts))
    return rows.groupBy("stratum", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counted(bitmaps: DataFrame, strata: Sequence[str]) -> DataFrame:
    """One row with the persons of each stratum, 0 where there is none; the bitmaps must be merged."""
    return bitmaps.agg(*(
        F.coalesce(F.sum(F.when(F.col("stratum") == name, F.bitmap_count("bits"))), F.lit(0)).alias(name) for name in strata))


def add_period(bitmaps: DataFrame, target: str, period: str) -> None:
    """Replace one period's bitmaps in a folder; those of other periods are neither read nor written."""
    bitmaps.select("stratum", "bucket", "bits").write.mode("overwrite").parquet(f"{target}/period={period}")


def periods(bitmaps: DataFrame, target: str) -> DataFrame:
    """All stored periods, with the columns of ``bitmaps`` and the period."""
    schema = bitmaps.select("stratum", "bucket", "bits", F.lit("").alias("period")).schema
    return bitmaps.sparkSession.read.schema(schema).parquet(target)


def numbered(persons: DataFrame, person: str, known: DataFrame | None = None) -> DataFrame:
    """person and number of all distinct persons; those in ``known`` keep theirs.

    A task numbers its new persons one after another; tasks take ranges of their
    own. The result is staged, since numbers depend on where rows lie.
    """
    new = persons.select(person).filter(F.col(person).isNotNull()).distinct()
    first = F.lit(1)
    if known is not None:
        new = new.join(known.select(person), person, "left_anti")
        first = F.coalesce(known.agg(F.max("number").alias("n")).scalar(), F.lit(0)) + 1
    added = new.withColumn("number", F.monotonically_increasing_id() + first)
    return stage(added if known is None else known.select(person, "number").unionByName(added), "numbered")
