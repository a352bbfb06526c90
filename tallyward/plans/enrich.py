"""Places and demographics for the final cohort, in the output layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward import schemas
from tallyward.functions.dates import datediff_boundary
from tallyward.functions.labels import HISPANIC, is_hispanic, race_group
from tallyward.functions.text import location_label, quote_wrap
from tallyward.operators.joins import inner_enrich, places
from tallyward.operators.setops import union_events
from tallyward.plans.ascertain import INPATIENT, OUTPATIENT, REGISTRY
from tallyward.plans.emergency import STAY, TREAT_AND_RELEASE
from tallyward.sources.staging import conform, stage
from tallyward.sources.tables import SourceTables


# Which fact an event's type tag says it came from, per role.
DIAGNOSIS_SOURCES = {REGISTRY: "registry", INPATIENT: "stay", OUTPATIENT: "visit"}
EMERGENCY_SOURCES = {STAY: "stay", TREAT_AND_RELEASE: "ed"}


def _role(df: DataFrame, type_col: str, id_col: str, sources: dict[str, str]) -> DataFrame:
    return df.replace(sources, subset=type_col).select(
        F.col(type_col).alias("_source"), F.col(id_col).alias("_id")
    )


def event_places(t: SourceTables, wanted: DataFrame, visits: DataFrame | None = None) -> DataFrame:
    """Where the wanted (source, id) events took place.

    Every fact is cut to the wanted ids by a semi join while it is scanned, once
    for all roles. Registry entries keep site and time, which are part of their
    key; other sources have NULL there. ``visits`` may hold the visits of the ids.
    """

    def hits(source: str, fact: DataFrame, fact_id: str) -> DataFrame:
        ids = wanted.filter(F.col("_source") == source).select(F.col("_id").alias(fact_id))
        registry = source == "registry"
        return fact.join(ids, fact_id, "left_semi").select(
            F.lit(source).alias("_source"), F.col(fact_id).alias("_id"), "Sta3n",
            (F.col("PatientSID") if registry else F.lit(None).cast("bigint")).alias("_site"),
            (F.col("DateDX") if registry else F.lit(None).cast("timestamp_ntz")).alias("_time"),
        )

    registry = hits("registry", t.oncology_primary, "OncologyPrimaryIEN")
    found = union_events(
        registry.filter(F.col("_site").isNotNull() & F.col("_time").isNotNull()),
        hits("stay", t.inpat_inpatient, "InpatientSID"),
        hits("visit", t.outpat_workload if visits is None else visits, "VisitSID"),
        hits("ed", t.edis_edislog, "VisitSID"),
    )
    return (
        found.join(places(t.dim_sta3n, t.dim_state), "Sta3n", "left").drop("Sta3n").distinct()
    )


def _attach(
    df: DataFrame, placed: DataFrame, type_col: str, id_col: str, sources: dict[str, str], out: str
) -> DataFrame:
    """One outer join for all types of a role instead of one pass per type.

    Only registry entries compare site and time; for the others these key parts
    are NULL on both sides and compared null-safe.
    """
    is_registry = F.col(type_col) == REGISTRY
    source = F.lit(None)
    for kind, name in sources.items():
        source = F.when(F.col(type_col) == kind, name).otherwise(source)
    probe = df.withColumns({
        "_own_source": source,
        "_own_site": F.when(is_registry, F.col("PatientSID")),
        "_own_time": F.when(is_registry, F.col("DiagnosisEventDateTime")),
    })
    same = (
        (F.col("_own_source") == F.col("_source")) & (F.col(id_col) == F.col("_id"))
        & F.col("_own_site").eqNullSafe(F.col("_site")) & F.col("_own_time").eqNullSafe(F.col("_time"))
    )
    nowhere = location_label(F.lit(None), F.lit(None))
    return probe.join(placed, same, "left").select(
        *df.columns, F.coalesce("Location", nowhere).alias(out)
    )


def with_locations(
    df: DataFrame, t: SourceTables, emergency: bool, visits: DataFrame | None = None,
) -> DataFrame:
    """Attach the place of the diagnosis and, in a second role, of the emergency event."""
    diagnosis = ("DiagnosisTypeOfEvent", "DiagnosisEventSID", DIAGNOSIS_SOURCES)
    roles = {"DiagnosisEventLocation": diagnosis}
    if emergency:
        roles["EmergencyEventLocation"] = ("ECTypeOfEvent", "ECEventSID", EMERGENCY_SOURCES)
    wanted = union_events(*(_role(df, *role) for role in roles.values()))
    placed = event_places(t, wanted, visits)
    if len(roles) > 1:
        placed = stage(placed, "places")
    for out, role in roles.items():
        df = _attach(df, placed, *role, out)
    return df


def with_demographics(df: DataFrame, t: SourceTables, persons: DataFrame | None = None) -> DataFrame:
    """Person attributes plus one row per distinct race label of the person.

    The person tables are cut to ``persons`` (default ``df``) while scanned.

    Persons without a race or ethnicity row vanish. Several rows multiply, but
    only through what the label depends on (race group, Hispanic or not), so a
    person with many copies of either adds at most a few rows.
    """
    person = t.spatient.select("PatientSID", "DeathDateTime", "Gender", "BirthDateTime")
    race = t.patient_race.select("PatientSID", race_group("Race").alias("_race"))
    ethnicity = t.patient_ethnicity.select("PatientSID", is_hispanic("Ethnicity").alias("_hispanic"))
    label = F.when(F.col("_hispanic"), HISPANIC).otherwise(F.col("_race"))
    ids = (df if persons is None else persons).select("PatientSID")
    cut = [r.join(ids, "PatientSID", "left_semi") for r in (person, race, ethnicity)]
    return inner_enrich(df, "PatientSID", *cut).withColumn("PatientRace", label)


def _layout(df: DataFrame, emergency: bool) -> DataFrame:
    emergency_columns = [
        F.col("ECEventDateTime").cast("date").alias("EmergencyEventDate"),
        F.col("EmergencyEventLocation"),
        F.col("ECTypeOfEvent").alias("TypeOfEmergencyEvent"),
    ]
    laid_out = df.select(
        quote_wrap("PatientSSN").alias("PatientSSN"),
        F.col("DiagnosisEventDateTime").cast("date").alias("DiagnosticEventDateTime"),
        "DiagnosisEventLocation", "TypeOfCancer", "StageOfCancer",
        F.col("DiagnosisTypeOfEvent").alias("TypeOfDiagnosisEvent"),
        *(emergency_columns if emergency else []),
        "HasPCPBeforeCutOff", "HasPCPAfterCutOff", "DeathDateTime",
        F.col("Gender").alias("PatientSex"),
        datediff_boundary("YEAR", F.col("BirthDateTime"), F.col("DiagnosisEventDateTime")).alias("PatientAge"),
        "PatientRace",
    )
    contract = schemas.NUMERATOR_OUTPUT if emergency else schemas.DENOMINATOR_OUTPUT
    return conform(laid_out.distinct(), contract)


def enrich_denominator(active: DataFrame, t: SourceTables, visits: DataFrame | None = None) -> DataFrame:
    """The denominator output; ``active`` is read several times and should be staged."""
    placed = with_locations(active, t, False, visits)
    return _layout(with_demographics(placed, t, active), emergency=False)


def enrich_numerator(active: DataFrame, t: SourceTables, visits: DataFrame | None = None) -> DataFrame:
    """The numerator output; ``active`` is read several times and should be staged."""
    placed = with_locations(active, t, True, visits)
    return _layout(with_demographics(placed, t, active), emergency=True)
