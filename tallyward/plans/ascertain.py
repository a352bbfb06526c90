"""Case ascertainment, washout, source precedence and the index event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.predicates import between_closed
from tallyward.functions.text import concat_null_empty
from tallyward.operators.firstlast import earliest_per_key
from tallyward.operators.joins import common_keys, not_in, semi
from tallyward.operators.projections import tag
from tallyward.operators.setops import union_events
from tallyward.params import Window, Windows
from tallyward.plans.conditions import ConditionSpec, coded_hits
from tallyward.sources.layout import in_window
from tallyward.sources.tables import SourceTables

# Event type tags and the placeholder of coded events.
REGISTRY = "REGISTRY ENTRY"
INPATIENT = "INPATIENT ENCOUNTER"
OUTPATIENT = "OUTPATIENT ENCOUNTER"
NOT_CAPTURED = "ZZZ NOT CAPTURED"

CASE_COLUMNS = (
    "PatientSSN", "PatientSID", "DiagnosisEventSID", "DiagnosisEventDateTime",
    "TypeOfCancer", "StageOfCancer", "TypeOfEvent",
)
PRIOR_COLUMNS = (
    "PatientSSN", "PatientSID", "DiagnosisEventSID", "DiagnosisEventDateTime", "TypeOfEvent",
)


def diagnosis_events(t: SourceTables, cond: ConditionSpec, window: Window) -> DataFrame:
    """Every event of the condition in the window, from all three sources."""
    person = t.spatient.select("PatientSID", "PatientSSN")

    def coded(fact: DataFrame, bridge: DataFrame, event: str, time: str, kind: str) -> DataFrame:
        hits = coded_hits(bridge, event, t.dim_icd10, t.dim_icd9, cond)
        found = (
            in_window(fact, time, window)
            .select(event, "PatientSID", F.col(time).alias("DiagnosisEventDateTime"))
            .join(hits, event, "inner")
            .withColumnRenamed(event, "DiagnosisEventSID")
        )
        return tag(
            found, TypeOfCancer=NOT_CAPTURED, StageOfCancer=NOT_CAPTURED, TypeOfEvent=kind
        )

    registry = in_window(t.oncology_primary, "DateDX", window).filter(cond.site()).select(
        "PatientSID",
        F.col("OncologyPrimaryIEN").alias("DiagnosisEventSID"),
        F.col("DateDX").alias("DiagnosisEventDateTime"),
        concat_null_empty("Histologyicdo3X", F.lit(" OF THE "), "ICDOSite").alias("TypeOfCancer"),
        F.col("StageGroupingajcc").alias("StageOfCancer"),
    )
    found = union_events(
        coded(t.outpat_workload, t.outpat_workload_vdiagnosis, "VisitSID", "VisitDateTime", OUTPATIENT),
        coded(t.inpat_inpatient, t.inpat_inpatient_diagnosis, "InpatientSID", "AdmitDateTime", INPATIENT),
        tag(registry, TypeOfEvent=REGISTRY),
    )
    # distinct sides make a distinct join, which AQE can split on a hot site id
    return found.distinct().join(person.distinct(), "PatientSID", "inner").select(*CASE_COLUMNS)


def find_prior(
    t: SourceTables, cond: ConditionSpec, window: Window, cases: DataFrame
) -> DataFrame:
    """Earlier events at the site ids the cases were seen at (other sites do not count)."""
    return semi(diagnosis_events(t, cond, window), cases, "PatientSID").select(
        *PRIOR_COLUMNS
    ).distinct()


def washout(cases: DataFrame, prior: DataFrame) -> DataFrame:
    """Cases of persons without prior history; removal is by person."""
    seen_before = common_keys(cases, prior, "PatientSSN")
    return not_in(cases, seen_before, "PatientSSN", null_list=False).distinct()


def index_event(cases: DataFrame) -> DataFrame:
    """First event(s) per person of cases already reduced to one source class each."""
    return earliest_per_key(cases, "PatientSSN", "DiagnosisEventDateTime").distinct()


def index_events(events: DataFrame, windows: Windows, by: Sequence[str] = ()) -> DataFrame:
    """Washout, source precedence and earliest event from one staged event relation.

    Equal to composing the three operators, but decided by one aggregate per
    person (pre-combined per site) and fetched by one join on person, time and
    source class. ``by`` names columns, such as study and condition, within whose
    values all of this is decided; the windows may then be columns of the events.
    """
    time, person, by = "DiagnosisEventDateTime", "PatientSSN", list(by)
    in_search = between_closed(time, *windows.search)
    in_washout = between_closed(time, *windows.washout)
    is_registry = F.col("TypeOfEvent") == REGISTRY
    per_person = (
        events.filter(F.col(person).isNotNull())
        .groupBy(*by, person, "PatientSID")
        .agg(
            (F.bool_or(in_search) & F.bool_or(in_washout)).alias("seen_before"),
            F.min(F.when(in_search & is_registry, F.col(time))).alias("registry_time"),
            F.min(F.when(in_search & ~is_registry, F.col(time))).alias("coded_time"),
        )
        .groupBy(*by, person)
        .agg(
            F.bool_or("seen_before").alias("seen_before"),
            F.min("registry_time").alias("registry_time"),
            F.min("coded_time").alias("coded_time"),
        )
    )
    index = per_person.filter(~F.col("seen_before")).select(
        *by, person,
        F.coalesce("registry_time", "coded_time").alias(time),
        F.col("registry_time").isNotNull().alias("from_registry"),
    )
    if by:
        voided = _voided_groups(events, per_person, in_search & is_registry, by)
        index = index.join(voided, [*by, "from_registry"], "left_anti")
    else:
        rejected = _coded_cases_rejected(events, per_person, in_search & is_registry)
        index = index.filter(F.col("from_registry") | ~rejected)
    cases = events.filter(in_search).withColumn("from_registry", is_registry)
    return cases.join(index, [*by, person, time, "from_registry"], "left_semi").select(*by, *CASE_COLUMNS)


def _voided_groups(events: DataFrame, per_person: DataFrame, registry_case: Column, by: list[str]) -> DataFrame:
    """The groups whose coded cases go: see :func:`_coded_cases_rejected`. One row a group at most."""
    unknown = events.filter(registry_case & F.col("PatientSSN").isNull()).select(*by).distinct()
    washed_out = per_person.filter("seen_before").select(*by).distinct()
    return unknown.join(washed_out, by, "left_anti").withColumn("from_registry", F.lit(False))


def _coded_cases_rejected(events: DataFrame, per_person: DataFrame, registry_case: Column) -> Column:
    """Whether a registry case without person voids the list that coded cases are tested against.

    NOT IN over a list with a NULL keeps nothing. Such a case survives washout
    only when nobody was washed out. Both numbers are scalar subqueries of the plan.
    """
    unknown_person = events.filter(registry_case & F.col("PatientSSN").isNull()).agg(F.count("*").alias("n"))
    washed_out = per_person.filter("seen_before").agg(F.count("*").alias("n"))
    return (unknown_person.scalar() > 0) & (washed_out.scalar() == 0)
