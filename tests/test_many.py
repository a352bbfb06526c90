"""Several conditions and studies at once equal the same one by one."""

from __future__ import annotations

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from compare import spark_rows, sql_rows
from tallyward import COLORECTAL, StudyParams
from tallyward.catalog import checks
from tallyward.catalog.checks import cohort_sql
from tallyward.catalog.cohorts import DX
from tallyward.functions.predicates import ci
from tallyward.params import Window
from tallyward.plans import ascertain, many
from tallyward.plans.cohort import Study
from tallyward.plans.conditions import LUNG, PROSTATE, ConditionSpec
from tallyward.sources.staging import stage
from test_queries import plan
from warehouse import START, random_warehouse, to_spark, to_sql

CONDITIONS = {"colorectal": COLORECTAL, "lung": LUNG, "appendix": ConditionSpec(("K35", "A0"), ("154.2", "15"), ("SKIN", "LU"))}
PATTERNS = {"colorectal": checks.COLORECTAL, "lung": checks.LUNG, "appendix": ("K35|A0", r"154\.2|15", "SKIN|LU")}
STUDIES = {"a": StudyParams(search_start=START), "b": StudyParams(search_start=datetime(1999, 1, 1)),
           "c": StudyParams(search_start=datetime(2000, 2, 1), search_length_months=3)}


@pytest.fixture(scope="module", params=[(3, True), (4, False)])
def case(request, spark):
    rows = random_warehouse(*request.param)
    tables = to_spark(spark, rows)
    return type(tables)(**{name: stage(df, name) for name, df in vars(tables).items()}), to_sql(rows)


def test_pieces_meet_the_patterns_they_would_match(spark):
    texts = ["C18.9", "xc20y ", "c19", "K", "", None, "153.4", "0153", "1530", "cOlOn", "RECTUM", "C1C18"]
    dim = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "sid int, code string")
    conditions = {**CONDITIONS, "short": ConditionSpec(("C", "18"), ("1", "CO"), ())}
    patterns = many.pattern_relation(spark, conditions)
    for system, rule in ((many.ICD10, "icd10"), (many.ICD9, "icd9")):
        found = many.matching_codes(dim, "sid", "code", patterns, conditions, system)
        expected = {(r["sid"], name) for name, spec in conditions.items() for r in dim.filter(getattr(spec, rule)("code")).collect()}
        assert {(r["sid"], r["condition"]) for r in found.collect()} == expected and expected
        assert found.count() == len(expected)
    assert many.coded_hits(dim.withColumns({"ICD10SID": F.col("sid"), "ICD9SID": F.col("sid")}), "code",
                           dim.toDF("ICD10SID", "ICD10Code"), dim.toDF("ICD9SID", "ICD9Code"),
                           many.pattern_relation(spark, {"n": PROSTATE}), {"n": PROSTATE}).count() == 0
    assert spark.range(1).select(F.size(many.beginnings(ci(F.lit("ab")), []))).first()[0] == 0


def test_pieces_are_never_broadcast(spark, case):
    """Spark takes them for no larger than their file; the patterns, which the driver made, are sent instead."""
    dim = stage(spark.range(2000).select(F.col("id").alias("sid"), F.lit("large ring").alias("code")), "dim")
    patterns = many.pattern_relation(spark, CONDITIONS)
    span = Window(F.lit("1950-01-01").cast("timestamp_ntz"), F.lit("2001-01-01").cast("timestamp_ntz"))
    for df in (
        *(many.matching_codes(dim, "sid", "code", patterns, CONDITIONS, system) for system in (many.ICD10, many.ICD9)),
        many.diagnosis_events(case[0], CONDITIONS, span),
    ):
        found = re.findall(r"\((\d+)\) BroadcastHashJoin.*\nLeft keys \[1\]: \[pattern#", plan(df))
        assert found and all(f"BroadcastHashJoin Inner BuildRight ({n})" in plan(df) for n in found)


def test_ascertainment_of_each_condition_in_one_pass(case):
    tables, con = case
    span = Window(F.lit("1950-01-01").cast("timestamp_ntz"), F.lit("2001-01-01").cast("timestamp_ntz"))
    found = stage(many.diagnosis_events(tables, CONDITIONS, span), "events")
    for name, spec in CONDITIONS.items():
        own = found.filter(F.col("condition") == name).drop("condition")
        assert spark_rows(own) == spark_rows(ascertain.diagnosis_events(tables, spec, span))
    text = plan(many.diagnosis_events(tables, CONDITIONS, span))
    scanned = re.findall(r"Location: InMemoryFileIndex \[.*/([\w-]+)-[0-9a-f]{32}\]", text)
    for fact in ("outpat_workload", "outpat_workload_vdiagnosis", "inpat_inpatient", "inpat_inpatient_diagnosis", "oncology_primary"):
        assert scanned.count(fact) == 1, "no fact is read per condition"


def test_index_events_of_each_study_and_condition(case):
    tables, con = case
    found = many.Studies(tables, STUDIES, CONDITIONS).index
    total = 0
    for s, params in STUDIES.items():
        for c, spec in CONDITIONS.items():
            own = found.filter((F.col("study") == s) & (F.col("condition") == c)).drop("study", "condition")
            assert spark_rows(own) == spark_rows(Study(tables, params, spec).index)
            total += own.count()
            if params.search_length_months == 12:
                expected = cohort_sql(f"SELECT {DX} FROM indexed", roles=False, start=str(params.search_start.date()), condition=PATTERNS[c])
                assert spark_rows(own) == sql_rows(con, expected)
    assert total == found.count() > 10


def test_two_start_years_in_one_run_equal_two_runs(case):
    tables, _ = case
    studies = many.Studies(tables, {k: STUDIES[k] for k in ("a", "b")}, {"colorectal": COLORECTAL})
    for output, rows in (("denominator", studies.denominators()), ("numerator", studies.numerators())):
        for name in ("a", "b"):
            own = rows.filter(F.col("study") == name).drop("study", "condition")
            assert spark_rows(own) == spark_rows(getattr(Study(tables, STUDIES[name], COLORECTAL), output)())
    assert studies.stages.paths
    studies.stages.release()
    assert studies.stages.paths == []


def test_empty_tables_have_no_events(spark):
    tables = to_spark(spark, {})
    assert many.Studies(tables, STUDIES, CONDITIONS).index.count() == 0
