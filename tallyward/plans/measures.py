"""Measure counts, exports and registry stage distributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.predicates import (
    ci, eq_tag, fold, in_bucket, none_like, not_any_like, other_or_null,
)
from tallyward.functions.text import report_line
from tallyward.operators.aggregates import (
    add_sums, count_strata, count_where, group_count_desc, tagged_distinct,
)
from tallyward.operators.projections import distinct_project
from tallyward.operators.setops import union_events
from tallyward.params import windows_of_row
from tallyward.plans.ascertain import REGISTRY
from tallyward.plans.conditions import ConditionSpec
from tallyward.sources.tables import cohort_slice

# Stages, buckets, export constants and report labels.
STAGES = ("I", "II", "III", "IV")
EARLY, LATE = ("I", "II"), ("III", "IV")
LEGACY_EARLY = ("I", "II", "0")
EP, LS = "EP", "LS"
STUDY_FIELD, SOURCE_FIELD = "_LCa_", "Registry"
LUNG_EXCLUSIONS = ("small%", "carcinoid%", "neuro%")
COLON_EXCLUSIONS = (
    "%carcinoid%", "%neuro%", "%adenoma%", "%lymph%", "gastrointestinal strom%", "%sarcoma%",
)
REPORT_LABELS = {
    "denominator": "Total Cancer Diagnoses",
    "ep_cases": "EP Numerator",
    "ls_late": "LS Numerator (Stage III and IV presentations)",
    "stage_i": "Stage I Presentations",
    "stage_ii": "Stage II Presentations",
    "stage_iii": "Stage III Presentations",
    "stage_iv": "Stage IV Presentations",
    "stage_other": 'Stage "Other" Presentations',
}

# Report lines that begin with a line break.
BREAK_BEFORE = ("ep_cases", "ls_late", "stage_i")
WINDOW_LABELS = {
    "search": ("Step 01 - Search Period Start", "Step 01 - Search Period End"),
    "washout": ("Step 02 - Exclusion Period Start", "Step 02 - Exclusion Period End"),
    "emergency": ("Step 05 - Emergency Care Search Period Start", "Step 05 - Emergency Care Search Period End"),
}
THRESHOLD_LABEL = "eStep 02 - Minimum Care History Threshold"
TIME_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSSS"

STAGE_COLUMN = "StageOfCancer"


def registry_rows(output: DataFrame) -> DataFrame:
    return cohort_slice(output, eq_tag("TypeOfDiagnosisEvent", REGISTRY))


def stage_strata(stage: str = STAGE_COLUMN) -> dict[str, Column]:
    strata = {f"stage_{name.lower()}": in_bucket(stage, [name]) for name in STAGES}
    return {**strata, "stage_other": other_or_null(stage, STAGES)}


def measure_summary(denominator: DataFrame, numerator: DataFrame) -> DataFrame:
    """All counts of the measure in one row, over registry rows only.

    Each output is read once: rows become (measure, person) pairs, which are
    deduplicated and counted together. Early and late are sums of stage counts.
    """
    of_denominator = {"denominator": F.lit(True), **stage_strata()}
    of_numerator = {"ep_cases": F.lit(True)}
    pairs = union_events(
        tagged_distinct(registry_rows(denominator), "PatientSSN", of_denominator),
        tagged_distinct(registry_rows(numerator), "PatientSSN", of_numerator),
    )
    counts = count_strata(pairs, ["denominator", "ep_cases", *stage_strata()])
    return add_sums(counts, {
        "ls_early": ["stage_i", "stage_ii"], "ls_late": ["stage_iii", "stage_iv"],
    })


def measure_report(summary: DataFrame) -> DataFrame:
    """The summary as (metric, value, line), in report order of the labels."""
    rows = F.array(*(
        F.struct(
            F.lit(label).alias("metric"),
            F.col(name).alias("value"),
            report_line(label, F.col(name), name in BREAK_BEFORE).alias("line"),
        )
        for name, label in REPORT_LABELS.items()
    ))
    return summary.select(F.inline(rows))


def study_report(params: DataFrame) -> DataFrame:
    """The windows' bounds and the care threshold of a parameter row, as (metric, value, line).

    Times are printed with seven decimals; the first line of each step begins
    with a line break.
    """
    found = windows_of_row()
    entries = []
    for name, labels in WINDOW_LABELS.items():
        for label, bound in zip(labels, getattr(found, name), strict=True):
            entries.append((label, F.date_format(bound, TIME_TEXT), bound is getattr(found, name).start))
    entries.append((THRESHOLD_LABEL, F.col("CareHx_Length_Months").cast("string"), True))
    rows = F.array(*(
        F.struct(F.lit(label).alias("metric"), value.alias("value"), report_line(label, value, first).alias("line"))
        for label, value, first in entries
    ))
    return params.select(F.inline(rows))


def export_ep(numerator: DataFrame, study: str = STUDY_FIELD) -> DataFrame:
    """Distinct emergency-to-diagnosis rows of the registry cases, under the study's label."""
    return distinct_project(
        registry_rows(numerator),
        "PatientSSN", *_export_fields(EP, study),
        F.col("EmergencyEventDate").alias("AntecedentEventStartDateTime"),
        F.col("EmergencyEventLocation").alias("AntecedentEventLocation"),
        *_subsequent(),
    )


def export_ls(denominator: DataFrame, study: str = STUDY_FIELD) -> DataFrame:
    """Distinct late-stage registry rows, under the study's label."""
    late = cohort_slice(registry_rows(denominator), in_bucket(STAGE_COLUMN, LATE))
    return distinct_project(late, "PatientSSN", *_export_fields(LS, study), *_subsequent())


def early_slice(denominator: DataFrame) -> DataFrame:
    return cohort_slice(registry_rows(denominator), in_bucket(STAGE_COLUMN, EARLY))


def _export_fields(evaluation: str, study: str) -> list[Column]:
    return [
        F.lit(evaluation).alias("TypeOfEvaluation"),
        F.lit(study).alias("StudyDescField1"),
        F.lit(SOURCE_FIELD).alias("StudyDescField2"),
        F.col(STAGE_COLUMN).alias("StudyDescField3"),
    ]


def _subsequent() -> list[Column]:
    return [
        F.col("DiagnosticEventDateTime").alias("SubsequentEventStartDateTime"),
        F.col("DiagnosisEventLocation").alias("SubsequentEventLocation"),
    ]


def registry_subset(
    registry: DataFrame, condition: ConditionSpec, exclusions: Sequence[str], *,
    jointly: bool = False, sites: Sequence[str] = (), histology: str = "Histologyicdo3X",
) -> DataFrame:
    """Registry rows of a site, without the histologies excluded (NULL is out too)."""
    text, patterns = ci(histology), fold(exclusions)
    kept = not_any_like(text, patterns) if jointly else none_like(text, patterns)
    return registry.filter(condition.site(*sites) & kept)


def stage_distribution(subset: DataFrame, stage: str = "StageGroupingajcc") -> DataFrame:
    return group_count_desc(subset, stage, fold_case=True)


def stage_bucket_count(
    subset: DataFrame, buckets: Sequence[str], stage: str = "StageGroupingajcc"
) -> DataFrame:
    return count_where(subset, in_bucket(stage, buckets))
