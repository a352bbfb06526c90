"""tallyward: person-level cohorts and event measures on Spark DataFrames."""

from tallyward.params import StudyParams, Window, Windows, windows
from tallyward.plans.cohort import build_cohorts, build_denominator, build_numerator
from tallyward.plans.conditions import COLORECTAL, LUNG, PROSTATE, ConditionSpec
from tallyward.sources.tables import SourceTables

__all__ = [
    "COLORECTAL", "LUNG", "PROSTATE", "ConditionSpec", "SourceTables", "StudyParams",
    "Window", "Windows", "build_cohorts", "build_denominator", "build_numerator", "windows",
]
