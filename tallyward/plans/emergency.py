"""Emergency events of a cohort: unplanned stays and emergency visits without admission."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions.predicates import ci, not_sentinel
from tallyward.functions.text import strip_dots
from tallyward.operators.intervals import asof_latest, followed_within, preceded_within
from tallyward.operators.joins import not_in, semi_code
from tallyward.operators.projections import tag
from tallyward.operators.setops import union_events
from tallyward.params import Window
from tallyward.sources.layout import in_window
from tallyward.sources.tables import SourceTables, code_set

# Emergency event tags and the admission span.
STAY = "INPATIENT"
TREAT_AND_RELEASE = "ED-Treat-and-Release"
ADMISSION_HOURS = 24

EVENT_COLUMNS = ("PatientSSN", "PatientSID", "ECEventSID", "ECEventDateTime", "TypeOfEvent")


def cohort_sites(cohort: DataFrame, spatient: DataFrame) -> DataFrame:
    """Every site id of every cohort person."""
    return spatient.select("PatientSSN", "PatientSID").join(
        cohort.select("PatientSSN"), "PatientSSN", "left_semi"
    ).distinct()


def _at_sites(events: DataFrame, sites: DataFrame, kind: str, *extra: str) -> DataFrame:
    """Events at the sites, distinct.

    Both sides are deduplicated before they meet: the join of distinct rows is
    distinct, and AQE can split it on a hot site id.
    """
    known = sites.select("PatientSSN", "PatientSID").distinct()
    return tag(events.distinct().join(known, "PatientSID", "inner"), TypeOfEvent=kind).select(
        *EVENT_COLUMNS, *extra
    )


def inpatient_candidates(t: SourceTables, sites: DataFrame, window: Window) -> DataFrame:
    stays = in_window(t.inpat_inpatient, "AdmitDateTime", window).select(
        "PatientSID",
        F.col("InpatientSID").alias("ECEventSID"),
        F.col("AdmitDateTime").alias("ECEventDateTime"),
    )
    return _at_sites(stays, sites, STAY)


def ed_visits(t: SourceTables, sites: DataFrame, window: Window) -> DataFrame:
    visits = in_window(t.edis_edislog, "PatientArrivalDateTime", window).filter(not_sentinel("VisitSID")).select(
        "PatientSID",
        F.col("VisitSID").alias("ECEventSID"),
        F.col("PatientArrivalDateTime").alias("ECEventDateTime"),
        F.col("DispositionDateTime").alias("ECEventEndDateTime"),
    )
    return _at_sites(visits, sites, TREAT_AND_RELEASE, "ECEventEndDateTime")


def followup_stays(stays: DataFrame) -> DataFrame:
    """Stays that can follow an emergency visit; the candidates themselves keep sentinels."""
    return stays.filter(not_sentinel("ECEventSID")).select(
        "PatientSSN", "PatientSID",
        F.col("ECEventSID").alias("InpSID"), F.col("ECEventDateTime").alias("InpDateTime"),
    ).distinct()


def planned_events(stays: DataFrame, t: SourceTables) -> DataFrame:
    """Stays with a diagnosis or procedure that implies a planned admission.

    The bridges are cut to ids, and these meet the stays in a semi join: no pairs
    form on an id that many bridge rows and stays share, like the sentinel.
    """

    def listed(bridge: DataFrame, dim: DataFrame, key: str, code: str, codes: DataFrame) -> DataFrame:
        wanted = semi_code(dim, _folded(codes), ci(strip_dots(code))).select(key)
        return bridge.join(wanted, key, "left_semi").select(F.col("InpatientSID").alias("ECEventSID"))

    by_diagnosis = listed(
        t.inpat_inpatient_diagnosis, t.dim_icd10, "ICD10SID", "ICD10Code",
        code_set(t.planned_conditions),
    )
    by_procedure = listed(
        t.inpat_inpatient_icd_procedure, t.dim_icd10_procedure,
        "ICD10ProcedureSID", "ICD10ProcedureCode",
        code_set(t.planned_procedures_always, t.planned_procedures_sometimes),
    )
    ids = union_events(by_diagnosis, by_procedure).distinct()
    return stays.select("PatientSSN", "ECEventSID").distinct().join(ids, "ECEventSID", "left_semi")


def _folded(codes: DataFrame) -> DataFrame:
    return codes.select(ci("code").alias("code"))


def ed_admitted(visits: DataFrame, stays: DataFrame, hours: int = ADMISSION_HOURS) -> DataFrame:
    """Ids of emergency visits followed by an admission at the same site."""
    followed = followed_within(
        visits, stays, "PatientSID", "ECEventEndDateTime", "InpDateTime", hours
    )
    return followed.select("ECEventSID").distinct()


def treat_and_release(
    visits: DataFrame, admitted: DataFrame, null_probes: bool = True
) -> DataFrame:
    """Emergency visits whose id is not an admitted one."""
    return not_in(visits, admitted, "ECEventSID", null_probes=null_probes, null_list=False)


def emergency_events(
    stays: DataFrame, planned: DataFrame, released: DataFrame, null_probes: bool = True
) -> DataFrame:
    """Unplanned stays and treat-and-release visits; planned stays go by event id alone."""
    unplanned = not_in(stays, planned, "ECEventSID", null_probes=null_probes, null_list=False)
    return union_events(
        unplanned.select(*EVENT_COLUMNS), released.select(*EVENT_COLUMNS)
    )


def emergency_from_candidates(candidates: DataFrame, t: SourceTables) -> DataFrame:
    """All emergency steps over one staged relation of candidate stays and visits.

    The id lists hold no NULL, since they come from joins on the id.
    """
    stays = candidates.filter(F.col("TypeOfEvent") == STAY)
    visits = candidates.filter(F.col("TypeOfEvent") == TREAT_AND_RELEASE)
    released = treat_and_release(visits, ed_admitted(visits, followup_stays(stays)))
    return emergency_events(stays, planned_events(stays, t), released)


def _as_dyad_sides(dx: DataFrame, ec: DataFrame) -> tuple[DataFrame, DataFrame]:
    emergency = ec.select(
        "PatientSSN", "ECEventSID", "ECEventDateTime", F.col("TypeOfEvent").alias("ECTypeOfEvent")
    )
    return dx.withColumnRenamed("TypeOfEvent", "DiagnosisTypeOfEvent"), emergency


def dyads(dx: DataFrame, ec: DataFrame, days: int) -> DataFrame:
    """Diagnosis events with every emergency event of the person in the days before."""
    dx, emergency = _as_dyad_sides(dx, ec)
    return preceded_within(
        dx, emergency, "PatientSSN", "DiagnosisEventDateTime", "ECEventDateTime", days
    ).distinct()


def latest_dyads(dx: DataFrame, ec: DataFrame, days: int) -> DataFrame:
    """The dyads with each person's latest emergency event, ties kept."""
    dx, emergency = _as_dyad_sides(dx, ec)
    return asof_latest(
        dx, emergency, "PatientSSN", "DiagnosisEventDateTime", "ECEventDateTime", days
    ).distinct()
