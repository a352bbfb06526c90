"""The pipeline on random warehouses full of edge rows, step by step, against SQL."""

from __future__ import annotations

import pytest

from compare import spark_rows, sql_rows
from tallyward import COLORECTAL, StudyParams
from tallyward.catalog.checks import SUMMARY, cohort_sql
from tallyward.catalog.cohorts import DX, DYAD, EC
from tallyward.operators.setops import prefer_source
from tallyward.plans import ascertain, emergency, history
from tallyward.plans.cohort import Study, build_cohorts
from tallyward.plans.measures import export_ls, measure_summary
from tallyward.sources.staging import stage
from warehouse import START, random_warehouse, to_spark, to_sql

PARAMS = StudyParams(search_start=START)


@pytest.fixture(scope="module", params=[(3, True), (4, False)])
def case(request, spark):
    rows = random_warehouse(*request.param)
    tables = to_spark(spark, rows)
    staged = {name: stage(df, name) for name, df in vars(tables).items()}
    return Study(type(tables)(**staged), PARAMS, COLORECTAL), to_sql(rows)


def check(df, con, select):
    expected = sql_rows(con, cohort_sql(select, roles=False))
    assert spark_rows(df) == expected
    return sum(expected[1].values())


def test_ascertainment(case):
    study, con = case
    cases = stage(ascertain.diagnosis_events(study.tables, study.condition, study.windows.search), "cases")
    prior = ascertain.find_prior(study.tables, study.condition, study.windows.washout, cases)
    assert check(cases, con, f"SELECT {DX} FROM cases") > 20
    check(prior, con, "SELECT PatientSSN, PatientSID, DiagnosisEventSID, DiagnosisEventDateTime, TypeOfEvent FROM prior")
    incident = stage(ascertain.washout(cases, prior), "incident")
    check(incident, con, f"SELECT {DX} FROM incident")
    preferred = stage(prefer_source(incident, "PatientSSN", "TypeOfEvent", ascertain.REGISTRY), "preferred")
    check(preferred, con, f"SELECT {DX} FROM preferred")
    check(ascertain.index_event(preferred), con, f"SELECT {DX} FROM indexed")
    again = ascertain.washout(incident, prior)
    assert spark_rows(again) == spark_rows(incident), "washing out twice changes nothing"


def test_fused_index_equals_steps(case):
    study, con = case
    assert check(study.index, con, f"SELECT {DX} FROM indexed") > 0


def test_emergency(case):
    study, con = case
    stays = emergency.inpatient_candidates(study.tables, study.sites, study.windows.emergency)
    visits = emergency.ed_visits(study.tables, study.sites, study.windows.emergency)
    check(stays, con, f"SELECT {EC} FROM stays")
    check(visits, con, f"SELECT {EC}, ECEventEndDateTime FROM ed")
    check(emergency.planned_events(stays, study.tables), con, "SELECT * FROM planned")
    admitted = emergency.ed_admitted(visits, emergency.followup_stays(stays))
    check(admitted, con, "SELECT * FROM admitted")
    check(emergency.treat_and_release(visits, admitted), con, f"SELECT {EC}, ECEventEndDateTime FROM released")
    check(study.emergency, con, f"SELECT {EC} FROM emergency")
    check(emergency.dyads(study.index, study.emergency, 30), con, f"SELECT {DYAD} FROM dyad")
    check(study.included_emergency, con, f"SELECT {DYAD} FROM last_dyad")


def test_history(case):
    study, con = case
    rows = stage(history.care_history(study.included, study.tables), "history")
    check(rows, con, "SELECT * FROM den_history")
    first, last = (history.history_delta(rows, first=f) for f in (True, False))
    check(first, con, "SELECT * FROM den_first")
    check(last, con, "SELECT * FROM den_last")
    months = PARAMS.carehx_length_months
    flagged = history.care_flags(study.included, study.bounds, months)
    check(flagged, con, "SELECT * FROM den_flagged")
    before = history.flag_from_delta(study.included, first, "HasPCPBeforeCutOff", ">", months)
    stepwise = history.flag_from_delta(before, last, "HasPCPAfterCutOff", "<", months)
    assert spark_rows(stepwise) == spark_rows(flagged)
    check(study.active(study.included_emergency), con, "SELECT * FROM num_active")


def test_outputs_and_measures(case):
    study, con = case
    denominator, numerator = (stage(df, "out") for df in (study.denominator(), study.numerator()))
    assert check(denominator, con, "SELECT * FROM den_output") > 0
    check(numerator, con, "SELECT * FROM num_output")
    summary = measure_summary(denominator, numerator)
    check(summary, con, SUMMARY)
    assert {r[0] for r in numerator.select("PatientSSN").collect()} <= {
        r[0] for r in denominator.select("PatientSSN").collect()}
    counts = summary.first()
    assert counts["ls_early"] == counts["stage_i"] + counts["stage_ii"]
    late = {r[0] for r in export_ls(denominator).select("PatientSSN").collect()}
    assert len(late) <= counts["ls_late"]


def test_build_cohorts_shares_stages(spark):
    rows = random_warehouse(8, False)
    con = to_sql(rows)
    denominator, numerator = build_cohorts(to_spark(spark, rows), PARAMS)
    check(denominator, con, "SELECT * FROM den_output")
    check(numerator, con, "SELECT * FROM num_output")
