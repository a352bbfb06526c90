"""The composed cohort operators, over the role views."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.catalog.checks import cohort_sql
from tallyward.catalog.registry import query, table
from tallyward.operators.setops import prefer_source
from tallyward.params import StudyParams
from tallyward.plans import ascertain, emergency, enrich, history
from tallyward.plans.cohort import Study, count_persons
from tallyward.plans.conditions import COLORECTAL, ConditionSpec, coded_hits
from tallyward.sources.roles import role_views
from tallyward.sources.staging import stage

PARAMS = StudyParams(search_start=datetime(2000, 1, 1))

DX = "PatientSSN, PatientSID, DiagnosisEventSID, DiagnosisEventDateTime, TypeOfCancer, StageOfCancer, TypeOfEvent"
DYAD = DX.replace("TypeOfEvent", "DiagnosisTypeOfEvent") + ", ECEventSID, ECEventDateTime, ECTypeOfEvent"
EC = "PatientSSN, PatientSID, ECEventSID, ECEventDateTime, TypeOfEvent"


def study(spark: SparkSession, d: str) -> Study:
    return Study(role_views(spark, d), PARAMS, COLORECTAL)


def _cases(s: Study) -> DataFrame:
    return ascertain.diagnosis_events(s.tables, s.condition, s.windows.search)


def _incident(s: Study) -> DataFrame:
    cases = stage(_cases(s), "cases")
    return ascertain.washout(cases, ascertain.find_prior(s.tables, s.condition, s.windows.washout, cases))


@query("""
    SELECT DISTINCT l_orderkey AS event_id FROM lineitem
      LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey
    WHERE p_name LIKE '%ing%' OR p_name LIKE '%anv%' OR s_name LIKE 'Supplier#000000001%'""")
def condition_match(spark, d):
    condition = ConditionSpec(icd10_contains=("ing", "anv"), icd9_prefix=("Supplier#000000001",), site_prefix=())
    bridge = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("event_id"),
        F.col("l_partkey").alias("ICD10SID"), F.col("l_suppkey").alias("ICD9SID"),
    )
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("ICD10SID"), F.col("p_name").alias("ICD10Code"))
    suppliers = table(spark, d, "supplier").select(F.col("s_suppkey").alias("ICD9SID"), F.col("s_name").alias("ICD9Code"))
    return coded_hits(bridge, "event_id", parts, suppliers, condition)


@query(cohort_sql(f"SELECT {DX} FROM cases"))
def case_ascertainment(spark, d):
    return _cases(study(spark, d))


@query(cohort_sql("SELECT PatientSSN, PatientSID, DiagnosisEventSID, DiagnosisEventDateTime, TypeOfEvent FROM prior"))
def prior_history(spark, d):
    s = study(spark, d)
    return ascertain.find_prior(s.tables, s.condition, s.windows.washout, stage(_cases(s), "cases"))


@query(cohort_sql(f"SELECT {DX} FROM incident"))
def incident_washout(spark, d):
    return _incident(study(spark, d))


@query(cohort_sql(f"SELECT {DX} FROM preferred"))
def source_precedence(spark, d):
    incident = stage(_incident(study(spark, d)), "incident")
    return prefer_source(incident, "PatientSSN", "TypeOfEvent", ascertain.REGISTRY)


@query(cohort_sql(f"SELECT {DX} FROM indexed"))
def index_event(spark, d):
    """From one staged event relation, as the pipeline does it."""
    return study(spark, d).index


@query(cohort_sql(f"SELECT {DX} FROM indexed"))
def index_event_stepwise(spark, d):
    """The same by composing washout, precedence and earliest event."""
    incident = stage(_incident(study(spark, d)), "incident")
    preferred = stage(prefer_source(incident, "PatientSSN", "TypeOfEvent", ascertain.REGISTRY), "preferred")
    return ascertain.index_event(preferred)


@query(cohort_sql(f"SELECT {EC} FROM stays"))
def inpatient_candidates(spark, d):
    s = study(spark, d)
    return emergency.inpatient_candidates(s.tables, s.sites, s.windows.emergency)


@query(cohort_sql("SELECT PatientSSN, ECEventSID FROM planned"))
def planned_events(spark, d):
    s = study(spark, d)
    return emergency.planned_events(s.candidates.filter(F.col("TypeOfEvent") == emergency.STAY), s.tables)


@query(cohort_sql(f"SELECT {EC}, ECEventEndDateTime FROM ed"))
def ed_visits(spark, d):
    s = study(spark, d)
    return emergency.ed_visits(s.tables, s.sites, s.windows.emergency)


@query(cohort_sql("SELECT PatientSSN, PatientSID, InpSID, InpDateTime FROM follow"))
def followup_stays(spark, d):
    s = study(spark, d)
    return emergency.followup_stays(s.candidates.filter(F.col("TypeOfEvent") == emergency.STAY))


def _visits_and_admitted(spark, d):
    s = study(spark, d)
    stays = s.candidates.filter(F.col("TypeOfEvent") == emergency.STAY)
    visits = s.candidates.filter(F.col("TypeOfEvent") == emergency.TREAT_AND_RELEASE)
    return visits, emergency.ed_admitted(visits, emergency.followup_stays(stays))


@query(cohort_sql("SELECT ECEventSID FROM admitted"))
def ed_followed_by_admission(spark, d):
    return _visits_and_admitted(spark, d)[1]


@query(cohort_sql(f"SELECT {EC}, ECEventEndDateTime FROM released"))
def ed_treat_release(spark, d):
    return emergency.treat_and_release(*_visits_and_admitted(spark, d))


@query(cohort_sql(f"SELECT {EC} FROM emergency"))
def emergency_events(spark, d):
    return study(spark, d).emergency


@query(cohort_sql(f"SELECT {DYAD} FROM dyad"))
def lookback_dyads(spark, d):
    s = study(spark, d)
    return emergency.dyads(s.index, s.emergency, 30)


@query(cohort_sql(f"SELECT {DYAD} FROM last_dyad"))
def latest_dyad(spark, d):
    return study(spark, d).included_emergency


_HX = "HistoricalEventSID, HistoricalEventDateTime, HistoricalTypeOfEvent"
_DEN = DX.replace("TypeOfEvent", "DiagnosisTypeOfEvent")


def _history(s: Study) -> DataFrame:
    return history.care_history(s.included, s.tables)


@query(cohort_sql(f"SELECT {_DEN}, {_HX} FROM den_history"))
def care_history(spark, d):
    return _history(study(spark, d))


@query(cohort_sql(f"""
    SELECT 'first' AS visit, {_DEN}, {_HX}, DxHxDelta FROM den_first
    UNION ALL SELECT 'last', {_DEN}, {_HX}, DxHxDelta FROM den_last"""))
def history_month_delta(spark, d):
    rows = stage(_history(study(spark, d)), "history")
    return history.history_delta(rows, first=True).withColumn("visit", F.lit("first")).unionByName(
        history.history_delta(rows, first=False).withColumn("visit", F.lit("last")))


@query(cohort_sql(f"SELECT {_DEN}, HasPCPBeforeCutOff, HasPCPAfterCutOff FROM den_flagged"))
def care_flags(spark, d):
    s = study(spark, d)
    return history.care_flags(s.included, s.bounds, PARAMS.carehx_length_months)


@query(cohort_sql(f"SELECT {_DEN}, HasPCPBeforeCutOff, HasPCPAfterCutOff FROM den_flagged"))
def care_flags_stepwise(spark, d):
    """The same from the first and last history rows."""
    s = study(spark, d)
    rows = stage(_history(s), "history")
    months = PARAMS.carehx_length_months
    first, last = (history.history_delta(rows, first=f) for f in (True, False))
    before = history.flag_from_delta(s.included, first, "HasPCPBeforeCutOff", ">", months)
    return history.flag_from_delta(before, last, "HasPCPAfterCutOff", "<", months)


@query(cohort_sql(f"SELECT {DYAD}, HasPCPBeforeCutOff, HasPCPAfterCutOff FROM num_active"))
def active_patients(spark, d):
    s = study(spark, d)
    return s.active(s.included_emergency)


@query(cohort_sql("SELECT * FROM den_output"))
def enrich_denominator(spark, d):
    s = study(spark, d)
    active = stage(s.active(s.included), "active")
    return enrich.enrich_denominator(active, s.tables)


@query(cohort_sql("SELECT * FROM num_output"))
def enrich_numerator(spark, d):
    s = study(spark, d)
    active = stage(s.active(s.included_emergency), "active")
    return enrich.enrich_numerator(active, s.tables)


@query(cohort_sql("SELECT * FROM den_output"))
def denominator_cohort(spark, d):
    return study(spark, d).denominator()


@query(cohort_sql("SELECT * FROM num_output"))
def numerator_cohort(spark, d):
    return study(spark, d).numerator()


@query(cohort_sql("""
    , span AS (SELECT dx.* FROM dx, bound WHERE DiagnosisEventDateTime BETWEEN w0 AND s1),
    sites AS (SELECT DISTINCT PatientSSN, PatientSID FROM spatient WHERE PatientSSN IN (SELECT PatientSSN FROM indexed))
    SELECT 'events' AS stage, 'rows' AS metric, count(*) AS n FROM span
    UNION ALL SELECT 'events', 'null_PatientSSN', count(*) - count(PatientSSN) FROM span
    UNION ALL SELECT 'events', 'null_PatientSID', count(*) - count(PatientSID) FROM span
    UNION ALL SELECT 'index', 'rows', count(*) FROM indexed
    UNION ALL SELECT 'index', 'null_PatientSSN', count(*) - count(PatientSSN) FROM indexed
    UNION ALL SELECT 'index', 'null_PatientSID', count(*) - count(PatientSID) FROM indexed
    UNION ALL SELECT 'index', 'persons', count(DISTINCT PatientSSN) FROM indexed
    UNION ALL SELECT 'sites', 'rows', count(*) FROM sites
    UNION ALL SELECT 'sites', 'null_PatientSSN', count(*) - count(PatientSSN) FROM sites
    UNION ALL SELECT 'sites', 'null_PatientSID', count(*) - count(PatientSID) FROM sites
    UNION ALL SELECT 'emergency', 'rows', count(*) FROM emergency
    UNION ALL SELECT 'emergency', 'null_PatientSSN', count(*) - count(PatientSSN) FROM emergency
    UNION ALL SELECT 'emergency', 'null_PatientSID', count(*) - count(PatientSID) FROM emergency"""))
def stage_counts(spark, d):
    """What was counted of the stages while they were written."""
    s = Study(role_views(spark, d), PARAMS, COLORECTAL)
    s.emergency  # noqa: B018  (writes the stages)
    return s.report()


@query(cohort_sql("""
    SELECT 'denominator' AS cohort, count(DISTINCT PatientSSN) AS persons FROM den_output
    UNION ALL SELECT 'numerator', count(DISTINCT PatientSSN) FROM num_output"""))
def cohort_person_counts(spark, d):
    s = study(spark, d)
    return count_persons(s.denominator()).withColumn("cohort", F.lit("denominator")).unionByName(
        count_persons(s.numerator()).withColumn("cohort", F.lit("numerator")))
