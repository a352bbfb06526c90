"""The pipeline end to end.

Every large fact is scanned with pruned columns and pushed windows, cut to the
condition or the cohort while scanned, and the small result is staged on shared
storage. What follows works on stages.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass, field
from functools import cached_property, wraps

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.params import StudyParams, Window, Windows, windows
from tallyward.plans.ascertain import OUTPATIENT, diagnosis_events, index_events
from tallyward.plans.conditions import COLORECTAL, ConditionSpec
from tallyward.plans.emergency import (
    cohort_sites, ed_visits, emergency_from_candidates, inpatient_candidates, latest_dyads,
)
from tallyward.plans.enrich import enrich_denominator, enrich_numerator
from tallyward.plans.history import active_only, bounds_of, care_flags, cohort_visits, event_visits
from tallyward.sources.outputs import replace_output
from tallyward.sources.staging import Stages, counted_stage, stage
from tallyward.sources.tables import SourceTables


def _held(build: Callable[[Study], DataFrame]) -> Callable[[Study], DataFrame]:
    """The stages that a step writes belong to its study."""
    @wraps(build)
    def run(study: Study) -> DataFrame:
        with study.stages.open():
            return build(study)

    return run


@dataclass(frozen=True)
class Study:
    """The steps of one study; each staged step is computed once and shared.

    ``stages.release()`` deletes the files of all steps, once the outputs have been
    written elsewhere; :func:`write_cohorts` does both.
    """

    tables: SourceTables
    params: StudyParams = StudyParams()
    condition: ConditionSpec = COLORECTAL
    stages: Stages = field(default_factory=Stages, compare=False)
    given_index: DataFrame | None = None
    """Index events that were found elsewhere, for several studies at once."""

    @cached_property
    def windows(self) -> Windows:
        return windows(self.params)

    @cached_property
    def counts(self) -> dict[str, dict[str, int]]:
        """By stage, what was counted while it was written: rows and NULL keys, and persons of the index."""
        return {}

    def _counted(self, df: DataFrame, name: str, *, persons: bool = False) -> DataFrame:
        staged, self.counts[name] = counted_stage(df, name, "PatientSSN", ["PatientSID"], persons=persons)
        return staged

    def report(self) -> DataFrame:
        """stage, metric and n of the stages written so far, without reading any of them."""
        rows = [(name, metric, n) for name, found in self.counts.items() for metric, n in found.items()]
        return self.tables.spatient.sparkSession.createDataFrame(rows, "stage string, metric string, n bigint")

    @cached_property
    @_held
    def events(self) -> DataFrame:
        """Events of the condition from the start of washout to the end of search."""
        span = Window(self.windows.washout.start, self.windows.search.end)
        return self._counted(diagnosis_events(self.tables, self.condition, span), "events")

    @cached_property
    @_held
    def index(self) -> DataFrame:
        if self.given_index is not None:
            return self.given_index
        return self._counted(index_events(self.events, self.windows), "index", persons=True)

    @cached_property
    @_held
    def sites(self) -> DataFrame:
        return self._counted(cohort_sites(self.index, self.tables.spatient), "sites")

    @cached_property
    @_held
    def visits(self) -> DataFrame:
        """The cohort's times of primary care and the visits that are index events, in one pass."""
        by_visit = self.index.filter(F.col("TypeOfEvent") == OUTPATIENT)
        ids = by_visit.select(F.col("DiagnosisEventSID").alias("VisitSID"))
        return stage(cohort_visits(self.tables, self.sites, ids), "visits")

    @property
    def bounds(self) -> DataFrame:
        return bounds_of(self.visits)

    @cached_property
    @_held
    def candidates(self) -> DataFrame:
        """Stays and emergency visits of the cohort in the emergency window."""
        stays = inpatient_candidates(self.tables, self.sites, self.windows.emergency)
        visits = ed_visits(self.tables, self.sites, self.windows.emergency)
        return stage(stays.unionByName(visits, allowMissingColumns=True), "candidates")

    @cached_property
    @_held
    def emergency(self) -> DataFrame:
        return self._counted(emergency_from_candidates(self.candidates, self.tables), "emergency")

    @property
    def included(self) -> DataFrame:
        """Denominator inclusion: the index events."""
        return self.index.withColumnRenamed("TypeOfEvent", "DiagnosisTypeOfEvent")

    @property
    def included_emergency(self) -> DataFrame:
        """Numerator inclusion: index events with their latest emergency event."""
        return latest_dyads(self.index, self.emergency, -self.params.lookback_length_days)

    def active(self, included: DataFrame) -> DataFrame:
        """Included rows of recently seen persons.

        All index events of a person share one time, so the index gives each
        included event the times its flags are made from.
        """
        months = self.params.carehx_length_months
        return active_only(care_flags(included, self.bounds, months, diagnoses=self.index))

    @_held
    def denominator(self) -> DataFrame:
        return enrich_denominator(stage(self.active(self.included), "active"), self.tables, event_visits(self.visits))

    def _together(self, *steps: str) -> None:
        """Write steps that need nothing of each other at once; their jobs share the cluster."""
        with ThreadPoolExecutor(len(steps)) as pool:
            waiting = [pool.submit(copy_context().run, getattr, self, step) for step in steps]
        for step in waiting:
            step.result()

    @_held
    def numerator(self) -> DataFrame:
        self.sites  # noqa: B018  (both steps start from it)
        self._together("visits", "emergency")
        active = stage(self.active(self.included_emergency), "active_emergency")
        return enrich_numerator(active, self.tables, event_visits(self.visits))


def build_denominator(
    tables: SourceTables, params: StudyParams = StudyParams(), condition: ConditionSpec = COLORECTAL
) -> DataFrame:
    return Study(tables, params, condition).denominator()


def build_numerator(
    tables: SourceTables, params: StudyParams = StudyParams(), condition: ConditionSpec = COLORECTAL
) -> DataFrame:
    return Study(tables, params, condition).numerator()


def build_cohorts(
    tables: SourceTables, params: StudyParams = StudyParams(), condition: ConditionSpec = COLORECTAL
) -> tuple[DataFrame, DataFrame]:
    """Denominator and numerator from shared stages."""
    study = Study(tables, params, condition)
    return study.denominator(), study.numerator()


def write_cohorts(
    tables: SourceTables, denominator: str, numerator: str,
    params: StudyParams = StudyParams(), condition: ConditionSpec = COLORECTAL,
) -> None:
    """Replace both output folders as wholes, and release every stage, also if a step fails."""
    study = Study(tables, params, condition)
    try:
        replace_output(study.denominator(), denominator)
        replace_output(study.numerator(), numerator)
    finally:
        study.stages.release()


def count_persons(output: DataFrame) -> DataFrame:
    return output.agg(F.count_distinct("PatientSSN").alias("persons"))
