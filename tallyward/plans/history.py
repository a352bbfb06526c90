"""Primary-care history of a cohort and the flags made from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.dates import datediff_boundary
from tallyward.functions.labels import flag_threshold, null_default
from tallyward.functions.predicates import flag_on, in_list, not_in_default, not_sentinel
from tallyward.operators.firstlast import earliest_per_key, latest_per_key, time_bounds
from tallyward.operators.joins import expand_identity, rejoin, role_dim
from tallyward.operators.projections import tag, with_star
from tallyward.sources.tables import SourceTables

# Clinic stop codes that are primary care, and those that never are.
PRIMARY_CARE_STOPS = (301, 322, 323, 348, 350, 531, 534, 539)
EXCLUDED_STOPS = (107, 115, 152, 311, 321, 328, 329, 333, 334, 430, 435, 474, 999)
HISTORY_TYPE = "PCP"

FLAG_KEYS = ("PatientSSN", "DiagnosisEventSID")


def is_primary_care(first: Column | str, second: Column | str) -> Column:
    primary = in_list(first, PRIMARY_CARE_STOPS) | in_list(null_default(second, 0), PRIMARY_CARE_STOPS)
    return primary & not_in_default(second, EXCLUDED_STOPS)


def care_stops(t: SourceTables) -> DataFrame:
    """Stop-code keys that are primary care when both roles read the same key."""
    stops = role_dim(
        t.dim_stopcode.select(F.col("StopCodeSID").alias("PrimaryStopCodeSID")),
        t.dim_stopcode, "PrimaryStopCodeSID", "StopCodeSID", "StopCode",
    )
    return stops.filter(is_primary_care("StopCode1", "StopCode2")).select("PrimaryStopCodeSID")


CARE, EVENT = "care", "event"
"""Why a visit is wanted: primary care at a site of the cohort, or by its id."""


def cohort_visits(t: SourceTables, sites: DataFrame, event_ids: DataFrame) -> DataFrame:
    """One reduced pass over the visits for all that the cohort needs of them.

    ``kind`` CARE: the first and last time of primary care of each person at the
    cohort's sites (``PatientSSN``, ``first_visit``, ``last_visit``). ``kind``
    EVENT: the stations of the visits by the ids of index events, of any time
    (``VisitSID``, ``Sta3n``).

    A visit's site and id become (kind, key) pairs, which meet the wanted pairs in
    one join, as the codes of a bridge do: the fact is cut to the cohort before
    anything else is asked, NULL and sentinel sites are never shuffled, and a hot
    site may be split. What is left is folded before it travels: care visits
    become two times per person, whatever their number.
    """
    fact = t.outpat_workload.select("VisitSID", "PatientSID", "VisitDateTime", "PrimaryStopCodeSID", "Sta3n")
    nothing = {f.name: F.lit(None).cast(f.dataType) for f in fact.schema}
    no_person = F.lit(None).cast(sites.schema["PatientSSN"].dataType)
    here = sites.filter(not_sentinel("PatientSID")).select(
        F.lit(CARE).alias("kind"), F.col("PatientSID").alias("key"), "PatientSSN")
    asked = event_ids.select(F.lit(EVENT).alias("kind"), F.col("VisitSID").alias("key"), no_person.alias("PatientSSN"))
    wanted = here.unionByName(asked).filter(F.col("key").isNotNull()).distinct()
    keys = F.array(
        F.struct(F.lit(CARE).alias("kind"), F.when(not_sentinel("PatientSID"), F.col("PatientSID")).alias("key"),
                 F.col("PrimaryStopCodeSID").alias("stop"), nothing["VisitSID"].alias("VisitSID"), nothing["Sta3n"].alias("Sta3n")),
        F.struct(F.lit(EVENT).alias("kind"), F.col("VisitSID").alias("key"),
                 nothing["PrimaryStopCodeSID"].alias("stop"), F.col("VisitSID"), F.col("Sta3n")))
    pairs = fact.select("VisitDateTime", F.inline(keys)).filter(F.col("key").isNotNull())
    found = pairs.join(wanted, ["kind", "key"], "inner")
    # care needs a primary-care stop, events none
    stops = care_stops(t).select(F.lit(CARE).alias("for_kind"), F.col("PrimaryStopCodeSID").alias("for_stop"))
    stops = stops.unionByName(
        fact.sparkSession.range(1).select(F.lit(EVENT).alias("for_kind"), nothing["PrimaryStopCodeSID"].alias("for_stop")))
    allowed = (F.col("kind") == F.col("for_kind")) & F.col("stop").eqNullSafe(F.col("for_stop"))
    kept = found.join(stops, allowed, "left_semi")
    has_null = F.bool_or(F.col("VisitDateTime").isNull())
    return kept.groupBy("kind", "PatientSSN", "VisitSID", "Sta3n").agg(
        F.when(~has_null, F.min("VisitDateTime")).alias("first_visit"), F.max("VisitDateTime").alias("last_visit"))


def bounds_of(visits: DataFrame) -> DataFrame:
    """First and last primary-care time per person, out of the :func:`cohort_visits`."""
    care = visits.filter((F.col("kind") == CARE) & F.col("PatientSSN").isNotNull())
    return care.select("PatientSSN", "first_visit", "last_visit")


def event_visits(visits: DataFrame) -> DataFrame:
    """The visits that are index events, out of the :func:`cohort_visits`."""
    return visits.filter(F.col("kind") == EVENT).select("VisitSID", "Sta3n")


def primary_care_visits(t: SourceTables, second_key: str | None = None) -> DataFrame:
    """Visits at real site ids to primary care, without bound in time.

    By default both stop-code roles read the primary key. The rule then depends
    on that key alone and is settled on the dimension, leaving one semi join on
    the visits; a second key needs the dimension joined twice.
    """
    visits = t.outpat_workload.filter(not_sentinel("PatientSID"))
    if second_key is None:
        visits = visits.join(care_stops(t), "PrimaryStopCodeSID", "left_semi")
    else:
        visits = role_dim(
            visits, t.dim_stopcode, "PrimaryStopCodeSID", "StopCodeSID", "StopCode", second_key)
        visits = visits.filter(is_primary_care("StopCode1", "StopCode2"))
    return visits.select("PatientSID", "VisitSID", "VisitDateTime")


def care_history(cohort: DataFrame, t: SourceTables, second_key: str | None = None) -> DataFrame:
    """Every primary-care visit of every cohort person, at all their sites."""
    visits = expand_identity(
        cohort.withColumnRenamed("PatientSID", "_cohort_sid"),
        t.spatient, primary_care_visits(t, second_key), "PatientSSN", "PatientSID", not_sentinel,
    )
    carried = [
        F.col("_cohort_sid").alias(c) if c == "PatientSID" else F.col(c) for c in cohort.columns
    ]
    history = visits.select(
        *carried,
        F.col("VisitSID").alias("HistoricalEventSID"),
        F.col("VisitDateTime").alias("HistoricalEventDateTime"),
    )
    return tag(history, HistoricalTypeOfEvent=HISTORY_TYPE).distinct()


def history_delta(history: DataFrame, *, first: bool) -> DataFrame:
    """First or last visits (ties kept) with the calendar months up to the diagnosis."""
    pick = earliest_per_key if first else latest_per_key
    months = datediff_boundary(
        "MONTH", F.col("HistoricalEventDateTime"), F.col("DiagnosisEventDateTime")
    )
    return with_star(pick(history, "PatientSSN", "HistoricalEventDateTime"), DxHxDelta=months).distinct()


def care_bounds(sites: DataFrame, t: SourceTables, second_key: str | None = None) -> DataFrame:
    """First and last primary-care visit time per person.

    The flags need these two times only, so the visit rows are never carried:
    they are folded into one row per person before the shuffle.
    """
    visits = primary_care_visits(t, second_key).select("PatientSID", "VisitDateTime")
    return time_bounds(
        visits.join(sites, "PatientSID", "inner"), "PatientSSN", "VisitDateTime",
        "first_visit", "last_visit",
    )


def care_flags(
    cohort: DataFrame, bounds: DataFrame, months: int, diagnoses: DataFrame | None = None
) -> DataFrame:
    """Attach the two flags: first visit long enough ago, last visit recent enough.

    Flags rejoin on person and event id. Should one event id stand for several
    diagnosis times, it carries the flags of each, in all combinations; the sets
    hold 0 and 1 at most. ``diagnoses`` may name a staged relation with the same
    times per event, so that an unstaged cohort is evaluated once only.
    """
    dx = F.col("DiagnosisEventDateTime")
    before = flag_threshold(datediff_boundary("MONTH", F.col("first_visit"), dx), ">", months)
    after = flag_threshold(datediff_boundary("MONTH", F.col("last_visit"), dx), "<", months)
    flags = (
        (cohort if diagnoses is None else diagnoses).select(*FLAG_KEYS, "DiagnosisEventDateTime")
        .join(bounds.filter(F.col("first_visit").isNotNull()), "PatientSSN", "inner")
        .groupBy(*FLAG_KEYS)
        .agg(F.collect_set(before).alias("_before"), F.collect_set(after).alias("_after"))
    )
    return (
        cohort.join(flags, list(FLAG_KEYS), "inner")
        .withColumn("HasPCPBeforeCutOff", F.explode("_before"))
        .withColumn("HasPCPAfterCutOff", F.explode("_after"))
        .drop("_before", "_after")
        .select(*cohort.columns, "HasPCPBeforeCutOff", "HasPCPAfterCutOff")
        .distinct()
    )


def flag_from_delta(cohort: DataFrame, delta: DataFrame, name: str, op: str, months: int) -> DataFrame:
    """One flag from a history-delta relation, rejoined on person and event id."""
    flags = delta.select(*FLAG_KEYS, flag_threshold("DxHxDelta", op, months).alias(name))
    return rejoin(cohort, flags, FLAG_KEYS).select(*cohort.columns, name).distinct()


def active_only(flagged: DataFrame) -> DataFrame:
    """Persons seen recently; the other flag is carried along but filters nothing.

    Flagged rows are distinct already.
    """
    return flagged.filter(flag_on("HasPCPAfterCutOff"))
