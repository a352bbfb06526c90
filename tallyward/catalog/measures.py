"""Measures, exports and registry distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyward.catalog.checks import SUMMARY, cohort_sql
from tallyward.catalog.cohorts import study
from tallyward.catalog.registry import query, table
from tallyward.params import StudyParams, params_df
from tallyward.plans import measures as M
from tallyward.plans.conditions import ConditionSpec
from tallyward.sources.staging import stage


def _outputs(spark, d):
    s = study(spark, d)
    return stage(s.denominator(), "denominator"), stage(s.numerator(), "numerator")


@query(cohort_sql(SUMMARY))
def measure_summary(spark, d):
    return M.measure_summary(*_outputs(spark, d))


@query(cohort_sql(f"""
    , summary AS ({SUMMARY})
    SELECT metric, value, opening || metric || ': ' || value AS line FROM (
      SELECT '' AS opening, 'Total Cancer Diagnoses' AS metric, denominator AS value FROM summary
      UNION ALL SELECT chr(13) || chr(10), 'EP Numerator', ep_cases FROM summary
      UNION ALL SELECT chr(13) || chr(10), 'LS Numerator (Stage III and IV presentations)', ls_late FROM summary
      UNION ALL SELECT chr(13) || chr(10), 'Stage I Presentations', stage_i FROM summary
      UNION ALL SELECT '', 'Stage II Presentations', stage_ii FROM summary
      UNION ALL SELECT '', 'Stage III Presentations', stage_iii FROM summary
      UNION ALL SELECT '', 'Stage IV Presentations', stage_iv FROM summary
      UNION ALL SELECT '', 'Stage "Other" Presentations', stage_other FROM summary) AS report"""))
def measure_report(spark, d):
    return M.measure_report(M.measure_summary(*_outputs(spark, d)))


@query("""
    WITH p AS (SELECT date_trunc('year', min(o_orderdate)) AS s FROM orders), line AS (
      SELECT 'Step 01 - Search Period Start' AS metric, s AS t, true AS opens FROM p
      UNION ALL SELECT 'Step 01 - Search Period End', s + INTERVAL 12 MONTH, false FROM p
      UNION ALL SELECT 'Step 02 - Exclusion Period Start', s - INTERVAL 50 YEAR, true FROM p
      UNION ALL SELECT 'Step 02 - Exclusion Period End', s, false FROM p
      UNION ALL SELECT 'Step 05 - Emergency Care Search Period Start', s - INTERVAL 30 DAY, true FROM p
      UNION ALL SELECT 'Step 05 - Emergency Care Search Period End', s + INTERVAL 12 MONTH, false FROM p),
    printed AS (
      SELECT metric, strftime(t, '%Y-%m-%d %H:%M:%S') || '.0000000' AS value, opens FROM line
      UNION ALL SELECT 'eStep 02 - Minimum Care History Threshold', '24', true)
    SELECT metric, value, CASE WHEN opens THEN chr(13) || chr(10) ELSE '' END || metric || ': ' || value AS line
    FROM printed""")
def study_report(spark, d):
    """The bounds of a study starting in the first year on record."""
    start = table(spark, d, "orders").agg(F.date_trunc("year", F.min("o_orderdate")).cast("timestamp_ntz").alias("start"))
    return M.study_report(params_df(spark, StudyParams(), start.scalar()))


@query(cohort_sql("""
    SELECT DISTINCT PatientSSN, 'EP' AS TypeOfEvaluation, '_LCa_' AS StudyDescField1,
      'Registry' AS StudyDescField2, StageOfCancer AS StudyDescField3,
      EmergencyEventDate AS AntecedentEventStartDateTime, EmergencyEventLocation AS AntecedentEventLocation,
      DiagnosticEventDateTime AS SubsequentEventStartDateTime, DiagnosisEventLocation AS SubsequentEventLocation
    FROM num_output WHERE TypeOfDiagnosisEvent = 'REGISTRY ENTRY'"""))
def export_ep(spark, d):
    return M.export_ep(study(spark, d).numerator())


@query(cohort_sql("""
    SELECT DISTINCT PatientSSN, 'LS' AS TypeOfEvaluation, '_LCa_' AS StudyDescField1,
      'Registry' AS StudyDescField2, StageOfCancer AS StudyDescField3,
      DiagnosticEventDateTime AS SubsequentEventStartDateTime, DiagnosisEventLocation AS SubsequentEventLocation
    FROM den_output WHERE TypeOfDiagnosisEvent = 'REGISTRY ENTRY' AND StageOfCancer IN ('III', 'IV')"""))
def export_ls(spark, d):
    return M.export_ls(study(spark, d).denominator())


@query(cohort_sql("""
    SELECT * FROM den_output WHERE TypeOfDiagnosisEvent = 'REGISTRY ENTRY' AND StageOfCancer IN ('I', 'II')"""))
def early_slice(spark, d):
    return M.early_slice(study(spark, d).denominator())


def _registry(spark, d):
    """Parts stand in for registry rows: the name is the histology, the type the stage."""
    return table(spark, d, "part").select(
        F.col("p_name").alias("SitegpX"), F.col("p_brand").alias("ICDOSite"), F.col("p_type").alias("PrimarysiteX"),
        F.nullif("p_name", F.lit("hot ring")).alias("Histologyicdo3X"),
        F.nullif("p_type", F.lit("PROMO")).alias("StageGroupingajcc"),
    )


_SITES = ConditionSpec(icd10_contains=(), icd9_prefix=(), site_prefix=("hot", "brand#1", "Sm"))
_SITE_SQL = "(p_name ILIKE 'hot%' OR p_name ILIKE 'sm%' OR p_brand ILIKE 'brand#1%' OR p_type ILIKE 'sm%')"
_EXCLUDED = ("NEW%", "old%", "%anvil")


@query(f"""
    SELECT count(*) AS n, nullif(p_type, 'PROMO') AS "StageGroupingajcc" FROM part
    WHERE {_SITE_SQL} AND NOT regexp_matches(nullif(p_name, 'hot ring'), '^(new|old)|anvil$')
    GROUP BY ALL""")
def stage_distribution_prefix_excl(spark, d):
    return M.stage_distribution(M.registry_subset(_registry(spark, d), _SITES, _EXCLUDED))


@query(f"""
    WITH kept AS (SELECT nullif(p_type, 'PROMO') AS stage FROM part
      WHERE {_SITE_SQL} AND NOT regexp_matches(nullif(p_name, 'hot ring'), '^(new|old)|anvil$'))
    SELECT 'early' AS bucket, count(*) AS n FROM kept WHERE stage IN ('SMALL', 'MEDIUM', 'LARGE')
    UNION ALL SELECT 'late', count(*) FROM kept WHERE stage IN ('ECONOMY', 'STANDARD')""")
def stage_bucket_counts(spark, d):
    subset = M.registry_subset(_registry(spark, d), _SITES, _EXCLUDED)
    early = M.stage_bucket_count(subset, ("SMALL", "MEDIUM", "LARGE")).withColumn("bucket", F.lit("early"))
    late = M.stage_bucket_count(subset, ("ECONOMY", "STANDARD")).withColumn("bucket", F.lit("late"))
    return early.unionByName(late)


@query(f"""
    SELECT count(*) AS n, nullif(p_type, 'PROMO') AS "StageGroupingajcc" FROM part
    WHERE {_SITE_SQL} AND NOT regexp_matches(nullif(p_name, 'hot ring'), 'bolt|iz|^new|lat|^cold ro|anvil')
    GROUP BY ALL""")
def stage_distribution_any_excl(spark, d):
    patterns = ("%BOLT%", "%iz%", "new%", "%lat%", "cold ro%", "%anvil%")
    return M.stage_distribution(M.registry_subset(_registry(spark, d), _SITES, patterns, jointly=True))
