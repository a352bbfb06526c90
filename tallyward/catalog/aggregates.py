"""Counts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallyward.catalog.registry import query, table
from tallyward.functions.predicates import in_bucket, other_or_null
from tallyward.operators import aggregates as A, bitmaps
from tallyward.sources.staging import stage, stage_root


@query("SELECT count(DISTINCT nullif(o_custkey, 3)) AS persons FROM orders")
def count_distinct_persons(spark, d):
    person = F.nullif(F.col("o_custkey"), F.lit(3).cast("bigint")).alias("o_custkey")
    return A.distinct_persons(table(spark, d, "orders").select(person), "o_custkey")


@query("SELECT count(*) FILTER (o_orderstatus = 'F' OR o_orderpriority = '5-LOW') AS n FROM orders")
def count_filtered(spark, d):
    condition = (F.col("o_orderstatus") == "F") | (F.col("o_orderpriority") == "5-LOW")
    return A.count_where(table(spark, d, "orders"), condition)


@query("""
    SELECT count(*) AS n, stage FROM (SELECT nullif(p_type, 'PROMO') AS stage FROM part) AS staged
    GROUP BY stage ORDER BY n DESC, stage NULLS LAST""")
def group_count_desc(spark, d):
    staged = table(spark, d, "part").select(F.nullif("p_type", F.lit("PROMO")).alias("stage"))
    return A.group_count_desc(staged, "stage")


_STRATA_SQL = """
    SELECT
      count(DISTINCT CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey END) AS stage_i,
      count(DISTINCT CASE WHEN o_orderpriority = '2-HIGH' THEN o_custkey END) AS stage_ii,
      count(DISTINCT CASE WHEN o_orderpriority = '3-MEDIUM' THEN o_custkey END) AS stage_iii,
      count(DISTINCT CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN o_custkey END)
        AS stage_other
    FROM orders WHERE o_orderstatus = 'P'"""


_KNOWN = ["1-URGENT", "2-HIGH", "3-MEDIUM"]
_STRATA = {
    "stage_i": _KNOWN[:1], "stage_ii": _KNOWN[1:2], "stage_iii": _KNOWN[2:], "stage_other": None,
}


def _conditions():
    return {
        name: other_or_null("o_orderpriority", _KNOWN) if known is None else in_bucket("o_orderpriority", known)
        for name, known in _STRATA.items()
    }


def _strata(spark, d):
    return A.strata_distinct(table(spark, d, "orders").filter("o_orderstatus = 'P'"), "o_custkey", _conditions())


@query(_STRATA_SQL)
def stage_strata_counts(spark, d):
    return _strata(spark, d)


@query(f"SELECT *, stage_i + stage_ii AS early, stage_iii + stage_other AS late FROM ({_STRATA_SQL}) AS strata")
def sum_of_strata(spark, d):
    return A.add_sums(_strata(spark, d), {"early": ["stage_i", "stage_ii"], "late": ["stage_iii", "stage_other"]})


@query(_STRATA_SQL)
def strata_from_bitmaps(spark, d):
    """The same counts from the bitmaps of each year, stored and merged."""
    rows = table(spark, d, "orders").filter("o_orderstatus = 'P'").withColumn("year", F.year("o_orderdate"))
    by_year = stage(bitmaps.strata_bitmaps(rows, "o_custkey", _conditions(), by=["year"]), "bitmaps")
    return bitmaps.counted(bitmaps.merged(by_year), list(_STRATA))


@query(_STRATA_SQL)
def strata_with_a_year_added(spark, d):
    """Years before 1998 are stored first; the later ones are added without the rows of the early ones."""
    rows = table(spark, d, "orders").filter("o_orderstatus = 'P'")
    early, late = (
        bitmaps.strata_bitmaps(rows.filter(part), "o_custkey", _conditions())
        for part in (F.year("o_orderdate") < 1998, F.year("o_orderdate") >= 1998))
    target = f"{stage_root(spark)}/periods-{uuid.uuid4().hex}"
    bitmaps.add_period(early, target, "early")
    bitmaps.add_period(late, target, "late")
    return bitmaps.counted(bitmaps.merged(bitmaps.periods(early, target)), list(_STRATA))


@query("""
    SELECT count(DISTINCT c_name) FILTER (c_acctbal < 0) AS poor, count(DISTINCT c_name) AS all_persons
    FROM customer JOIN orders ON o_custkey = c_custkey""")
def persons_numbered_for_bitmaps(spark, d):
    """Persons known by a text are numbered first, in two steps."""
    named = table(spark, d, "orders").select("o_custkey").join(
        table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_acctbal"), "o_custkey")
    known = bitmaps.numbered(named.filter("c_acctbal < 5000"), "c_name")
    numbers = bitmaps.numbered(named, "c_name", known)
    rows = named.join(numbers, "c_name")
    strata = {"poor": F.col("c_acctbal") < 0, "all_persons": F.lit(True)}
    return bitmaps.counted(bitmaps.merged(bitmaps.strata_bitmaps(rows, "number", strata)), list(strata))
