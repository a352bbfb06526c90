"""Several conditions and several studies from one pass over the facts.

Conditions are a relation of patterns, (condition, system, pattern). A code is cut
into the pieces a pattern could be, its beginnings or all its runs of the lengths
that patterns have, and pieces meet patterns by equality: one join on each code
dimension for any number of conditions, and none of the facts is read per
condition. Patterns are the side that is broadcast: they come from the driver, while
Spark takes pieces, many from each code, for no larger than the file they are cut from. Studies are parameter rows; the events meet them by the years that
their windows cover, and the index events of all studies and conditions are
decided together.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.functions.predicates import ci, fold
from tallyward.functions.text import concat_null_empty
from tallyward.operators.projections import tag
from tallyward.operators.setops import union_events
from tallyward.params import StudyParams, Window, params_df, windows, windows_of_row
from tallyward.plans.ascertain import (
    CASE_COLUMNS, INPATIENT, NOT_CAPTURED, OUTPATIENT, REGISTRY, index_events,
)
from tallyward.plans.cohort import Study
from tallyward.plans.conditions import SITE_COLUMNS, ConditionSpec
from tallyward.sources.layout import in_window, years_of
from tallyward.sources.staging import Stages, stage
from tallyward.sources.tables import SourceTables

Conditions = Mapping[str, ConditionSpec]
ICD10, ICD9, SITE = "icd10", "icd9", "site"


def pattern_relation(spark: SparkSession, conditions: Conditions) -> DataFrame:
    """condition, system and pattern, folded for comparison; one row for each pattern."""
    rows = [
        (name, system, pattern)
        for name, spec in conditions.items()
        for system, patterns in ((ICD10, spec.icd10_contains), (ICD9, spec.icd9_prefix), (SITE, spec.site_prefix))
        for pattern in fold(patterns)
    ]
    return spark.createDataFrame(rows, "condition string, system string, pattern string")


def _lengths(conditions: Conditions, system: str) -> list[int]:
    of = {ICD10: "icd10_contains", ICD9: "icd9_prefix", SITE: "site_prefix"}[system]
    return sorted({len(p) for spec in conditions.values() for p in fold(getattr(spec, of))})


def beginnings(text: Column, lengths: list[int]) -> Column:
    """The beginnings of a text of the given lengths, as far as it reaches; none of NULL."""
    pieces = [F.when(F.char_length(text) >= n, F.substring(text, 1, n)) for n in lengths]
    return F.filter(F.array(*pieces, F.lit(None).cast("string")), lambda piece: piece.isNotNull())


def runs(text: Column, lengths: list[int]) -> Column:
    """The distinct runs of characters of the given lengths anywhere in a text; none of NULL."""
    def of(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.char_length(text) - n + 1, F.lit(1)))
        found = F.transform(starts, lambda at: F.substring(text, at, F.lit(n)))
        return F.when(F.char_length(text) >= n, found).otherwise(F.array().cast("array<string>"))

    pieces = F.array_distinct(F.flatten(F.array(*(of(n) for n in lengths)))) if lengths else F.array().cast("array<string>")
    return F.coalesce(pieces, F.array().cast("array<string>"))


def matching_codes(
    dim: DataFrame, key: str, code: str, patterns: DataFrame, conditions: Conditions, system: str,
) -> DataFrame:
    """sid and condition of the codes that a pattern of the system matches."""
    cut = runs if system == ICD10 else beginnings
    pieces = dim.select(F.col(key).alias("sid"), F.explode(cut(ci(code), _lengths(conditions, system))).alias("pattern"))
    wanted = patterns.filter(F.col("system") == system).select("condition", "pattern")
    return pieces.join(F.broadcast(wanted), "pattern").select("sid", "condition").distinct()


def coded_hits(
    bridge: DataFrame, event: str, dim_icd10: DataFrame, dim_icd9: DataFrame, patterns: DataFrame, conditions: Conditions,
) -> DataFrame:
    """Distinct (event, condition) of events with a matching code in either system; the bridge is scanned once."""
    codes = union_events(
        tag(matching_codes(dim_icd10, "ICD10SID", "ICD10Code", patterns, conditions, ICD10), system=10),
        tag(matching_codes(dim_icd9, "ICD9SID", "ICD9Code", patterns, conditions, ICD9), system=9),
    )
    keys = F.array(
        F.struct(F.lit(10).alias("system"), F.col("ICD10SID").alias("sid")),
        F.struct(F.lit(9).alias("system"), F.col("ICD9SID").alias("sid")),
    )
    pairs = bridge.select(event, F.inline(keys)).filter(F.col("sid").isNotNull())
    return pairs.join(codes, ["system", "sid"], "inner").select(event, "condition").distinct()


def diagnosis_events(t: SourceTables, conditions: Conditions, window: Window) -> DataFrame:
    """Every event of each condition in the window, from all three sources, with its ``condition``."""
    spark = t.spatient.sparkSession
    patterns = pattern_relation(spark, conditions)
    person = t.spatient.select("PatientSID", "PatientSSN")

    def coded(fact: DataFrame, bridge: DataFrame, event: str, time: str, kind: str) -> DataFrame:
        hits = coded_hits(bridge, event, t.dim_icd10, t.dim_icd9, patterns, conditions)
        found = (
            in_window(fact, time, window)
            .select(event, "PatientSID", F.col(time).alias("DiagnosisEventDateTime"))
            .join(hits, event, "inner")
            .withColumnRenamed(event, "DiagnosisEventSID")
        )
        return tag(found, TypeOfCancer=NOT_CAPTURED, StageOfCancer=NOT_CAPTURED, TypeOfEvent=kind)

    lengths = _lengths(conditions, SITE)
    pieces = F.array_distinct(F.flatten(F.array(*(beginnings(ci(c), lengths) for c in SITE_COLUMNS))))
    sites = patterns.filter(F.col("system") == SITE).select("condition", "pattern")
    registry = (
        in_window(t.oncology_primary, "DateDX", window).select(
            "PatientSID",
            F.col("OncologyPrimaryIEN").alias("DiagnosisEventSID"),
            F.col("DateDX").alias("DiagnosisEventDateTime"),
            concat_null_empty("Histologyicdo3X", F.lit(" OF THE "), "ICDOSite").alias("TypeOfCancer"),
            F.col("StageGroupingajcc").alias("StageOfCancer"),
            F.explode(pieces).alias("pattern"),
        )
        .join(F.broadcast(sites), "pattern").drop("pattern")
    )
    found = union_events(
        coded(t.outpat_workload, t.outpat_workload_vdiagnosis, "VisitSID", "VisitDateTime", OUTPATIENT),
        coded(t.inpat_inpatient, t.inpat_inpatient_diagnosis, "InpatientSID", "AdmitDateTime", INPATIENT),
        tag(registry, TypeOfEvent=REGISTRY),
    )
    return found.distinct().join(person.distinct(), "PatientSID", "inner").select("condition", *CASE_COLUMNS)


def study_relation(spark: SparkSession, studies: Mapping[str, StudyParams]) -> DataFrame:
    """A parameter row for each study, with its name."""
    rows = [params_df(spark, p).withColumn("study", F.lit(name)) for name, p in studies.items()]
    return union_events(*rows)


def in_windows(events: DataFrame, studies: DataFrame, time: str = "DiagnosisEventDateTime") -> DataFrame:
    """Events with the parameter row of each study in whose washout or search window they lie.

    Both sides carry years: a study has one row for each year that its windows
    cover, an event meets those of its own year.
    """
    w = windows_of_row()
    covered = studies.withColumn("_year", F.explode(years_of(w.washout.start, w.search.end)))
    met = events.withColumn("_year", F.year(time)).join(covered, "_year").drop("_year")
    return met.filter(F.col(time).between(w.washout.start, w.search.end))


@dataclass(frozen=True)
class Studies:
    """Cohorts of several studies and conditions; the shared steps are staged once for all."""

    tables: SourceTables
    studies: Mapping[str, StudyParams]
    conditions: Conditions
    stages: Stages = field(default_factory=Stages, compare=False)

    @cached_property
    def events(self) -> DataFrame:
        """Events of all conditions from the first washout to the last search day."""
        found = [windows(p) for p in self.studies.values()]
        starts, ends = [w.washout.start for w in found], [w.search.end for w in found]
        span = Window(starts[0] if len(starts) < 2 else F.least(*starts), ends[0] if len(ends) < 2 else F.greatest(*ends))
        with self.stages.open():
            return stage(diagnosis_events(self.tables, self.conditions, span), "events")

    @cached_property
    def index(self) -> DataFrame:
        """study, condition and the index events of each."""
        relation = study_relation(self.events.sparkSession, self.studies)
        with self.stages.open():
            assigned = stage(in_windows(self.events, relation), "assigned")
            return stage(index_events(assigned, windows_of_row(), by=("study", "condition")), "index")

    def study(self, name: str, condition: str) -> Study:
        """One study of one condition, which goes on from the shared index events and holds its own stages."""
        own = self.index.filter((F.col("study") == name) & (F.col("condition") == condition))
        return Study(self.tables, self.studies[name], self.conditions[condition], self.stages, own.drop("study", "condition"))

    def denominators(self) -> DataFrame:
        """The denominators of all studies and conditions under one another, with both names."""
        return self._all("denominator")

    def numerators(self) -> DataFrame:
        return self._all("numerator")

    def _all(self, output: str) -> DataFrame:
        return union_events(*(
            tag(getattr(self.study(name, condition), output)(), study=name, condition=condition)
            for name in self.studies for condition in self.conditions))
