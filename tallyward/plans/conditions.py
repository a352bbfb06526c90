"""Which disease a study is about."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.functions.predicates import (
    any_column_prefix, ci, contains_any, fold, prefix_any,
)
from tallyward.operators.projections import tag
from tallyward.operators.setops import union_events

SITE_COLUMNS = ("SitegpX", "ICDOSite", "PrimarysiteX")


@dataclass(frozen=True)
class ConditionSpec:
    """Code patterns: ICD-10 anywhere in the code, ICD-9 and registry sites as prefixes."""

    icd10_contains: tuple[str, ...]
    icd9_prefix: tuple[str, ...]
    site_prefix: tuple[str, ...]

    def icd10(self, code: Column | str) -> Column:
        return contains_any(ci(code), fold(self.icd10_contains))

    def icd9(self, code: Column | str) -> Column:
        return prefix_any(ci(code), fold(self.icd9_prefix))

    def site(self, *columns: Column | str) -> Column:
        return any_column_prefix([ci(c) for c in columns or SITE_COLUMNS], fold(self.site_prefix))


# The code patterns of each condition.
COLORECTAL = ConditionSpec(
    icd10_contains=("C18", "C19", "C20"),
    icd9_prefix=("153", "154.0", "154.1"),
    site_prefix=("COLO", "RECT"),
)
LUNG = ConditionSpec(icd10_contains=("C34",), icd9_prefix=("162",), site_prefix=("LUNG",))
PROSTATE = ConditionSpec(icd10_contains=("C61",), icd9_prefix=("185",), site_prefix=("PROSTATE",))


def coded_hits(
    bridge: DataFrame, event: str, dim_icd10: DataFrame, dim_icd9: DataFrame, cond: ConditionSpec
) -> DataFrame:
    """Distinct ids of events with a matching code in either coding system.

    A bridge row has a key in one system or the other. Its keys become
    (system, key) pairs, the missing one is dropped, and one semi join against
    the matching codes of both systems settles the OR. The patterns run on the
    dimensions, the bridge is scanned once, no NULL key is ever shuffled, and
    the hits are deduplicated before they travel.
    """
    codes = union_events(
        tag(dim_icd10.filter(cond.icd10("ICD10Code")), system=10).select("system", F.col("ICD10SID").alias("sid")),
        tag(dim_icd9.filter(cond.icd9("ICD9Code")), system=9).select("system", F.col("ICD9SID").alias("sid")),
    )
    keys = F.array(
        F.struct(F.lit(10).alias("system"), F.col("ICD10SID").alias("sid")),
        F.struct(F.lit(9).alias("system"), F.col("ICD9SID").alias("sid")),
    )
    pairs = bridge.select(event, F.inline(keys)).filter(F.col("sid").isNotNull())
    return pairs.join(codes, ["system", "sid"], "left_semi").select(event).distinct()
