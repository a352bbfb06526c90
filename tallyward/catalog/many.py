"""Several conditions and studies at once."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import functions as F

from tallyward.catalog import checks
from tallyward.catalog.checks import cohort_sql
from tallyward.catalog.cohorts import DX, PARAMS
from tallyward.catalog.registry import query, table
from tallyward.params import windows
from tallyward.plans import many
from tallyward.plans.conditions import COLORECTAL, LUNG, PROSTATE, ConditionSpec
from tallyward.sources.roles import role_views

CONDITIONS = {"colorectal": COLORECTAL, "lung": LUNG, "prostate": PROSTATE}
PATTERNS = {"colorectal": checks.COLORECTAL, "lung": checks.LUNG, "prostate": checks.PROSTATE}
STUDIES = {"2000": PARAMS, "1997": replace(PARAMS, search_start=datetime(1997, 1, 1))}


def _each(select: str, studies=("2000",), conditions=tuple(PATTERNS)) -> str:
    """``select`` over the steps of every study and condition, each by a statement of its own."""
    parts = [
        f"SELECT '{s}' AS study, '{c}' AS condition, * FROM ({cohort_sql(select, start=f'{s}-01-01', condition=PATTERNS[c])})"
        for s in studies for c in conditions
    ]
    return " UNION ALL ".join(parts)


@query("""
    SELECT DISTINCT l_orderkey AS event_id, condition FROM lineitem
      LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey
      JOIN (VALUES ('rings', 'ring|anv', 'supplier#000000001'), ('bolts', 'bolt', 'supplier#00000000[24]'),
        ('none', 'qqq', 'qqq')) AS c(condition, anywhere, opening)
      ON regexp_matches(p_name, anywhere, 'i') OR regexp_matches(s_name, '^(' || opening || ')', 'i')""")
def condition_match_many(spark, d):
    conditions = {
        "rings": ConditionSpec(("ring", "ANV"), ("Supplier#000000001",), ()),
        "bolts": ConditionSpec(("bolt",), ("supplier#000000002", "Supplier#000000004"), ()),
        "none": ConditionSpec(("qqq",), ("qqq",), ()),
    }
    bridge = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("event_id"),
        F.col("l_partkey").alias("ICD10SID"), F.col("l_suppkey").alias("ICD9SID"),
    )
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("ICD10SID"), F.col("p_name").alias("ICD10Code"))
    suppliers = table(spark, d, "supplier").select(F.col("s_suppkey").alias("ICD9SID"), F.col("s_name").alias("ICD9Code"))
    patterns = many.pattern_relation(spark, conditions)
    return many.coded_hits(bridge, "event_id", parts, suppliers, patterns, conditions)


@query(_each(f"SELECT {DX} FROM cases").replace("'2000' AS study, ", ""))
def case_ascertainment_many(spark, d):
    return many.diagnosis_events(role_views(spark, d), CONDITIONS, windows(PARAMS).search)


@query(_each(f"SELECT {DX} FROM indexed", tuple(STUDIES)))
def index_event_many(spark, d):
    """Three conditions in two studies, from one relation of events."""
    return many.Studies(role_views(spark, d), STUDIES, CONDITIONS).index


@query(_each("SELECT * FROM den_output", ("1997",), ("colorectal", "lung")))
def denominator_cohorts(spark, d):
    conditions = {c: CONDITIONS[c] for c in ("colorectal", "lung")}
    return many.Studies(role_views(spark, d), {"1997": STUDIES["1997"]}, conditions).denominators()
