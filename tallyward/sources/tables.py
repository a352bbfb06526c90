"""The warehouse relations a study reads."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.operators.setops import union_events


def read_source(spark: SparkSession, directory: str, name: str, cols: Sequence[str]) -> DataFrame:
    """Scan a fact relation, reading only the named columns."""
    return spark.read.parquet(f"{directory}/{name}.parquet").select(*cols)


def read_dim(
    spark: SparkSession, directory: str, name: str, key: str, cols: Sequence[str]
) -> DataFrame:
    """Scan a dimension; it may live in a directory or database of its own."""
    return read_source(spark, directory, name, [key, *cols])


def code_set(*lists: DataFrame, col: str = "code") -> DataFrame:
    """One code set from one or more uploaded lists, whatever their column is called."""
    columns = [codes.select(F.col(codes.columns[0]).alias(col)) for codes in lists]
    return union_events(*columns)


def cohort_slice(cohort: DataFrame, condition: Column) -> DataFrame:
    return cohort.filter(condition)


# Fixed names: the columns the pipeline reads of each relation.
COLUMNS = {
    "outpat_workload": ("VisitSID", "PatientSID", "VisitDateTime", "PrimaryStopCodeSID", "Sta3n"),
    "outpat_workload_vdiagnosis": ("VisitSID", "ICD10SID", "ICD9SID"),
    "inpat_inpatient": ("InpatientSID", "PatientSID", "AdmitDateTime", "Sta3n"),
    "inpat_inpatient_diagnosis": ("InpatientSID", "ICD10SID", "ICD9SID"),
    "inpat_inpatient_icd_procedure": ("InpatientSID", "ICD10ProcedureSID"),
    "oncology_primary": (
        "PatientSID", "OncologyPrimaryIEN", "DateDX", "Histologyicdo3X", "ICDOSite", "SitegpX",
        "PrimarysiteX", "StageGroupingajcc", "Sta3n",
    ),
    "edis_edislog": (
        "VisitSID", "PatientSID", "PatientArrivalDateTime", "DispositionDateTime", "Sta3n",
    ),
    "spatient": ("PatientSID", "PatientSSN", "DeathDateTime", "Gender", "BirthDateTime"),
    "patient_race": ("PatientSID", "Race"),
    "patient_ethnicity": ("PatientSID", "Ethnicity"),
    "dim_icd10": ("ICD10SID", "ICD10Code"),
    "dim_icd9": ("ICD9SID", "ICD9Code"),
    "dim_icd10_procedure": ("ICD10ProcedureSID", "ICD10ProcedureCode"),
    "dim_stopcode": ("StopCodeSID", "StopCode"),
    "dim_sta3n": ("Sta3n", "City", "StateSID"),
    "dim_state": ("StateSID", "State"),
    "planned_conditions": ("code",),
    "planned_procedures_always": ("code",),
    "planned_procedures_sometimes": ("code",),
}


def _is_dim(name: str) -> bool:
    return name.startswith("dim_")


@dataclass(frozen=True)
class SourceTables:
    outpat_workload: DataFrame
    outpat_workload_vdiagnosis: DataFrame
    inpat_inpatient: DataFrame
    inpat_inpatient_diagnosis: DataFrame
    inpat_inpatient_icd_procedure: DataFrame
    oncology_primary: DataFrame
    edis_edislog: DataFrame
    spatient: DataFrame
    patient_race: DataFrame
    patient_ethnicity: DataFrame
    dim_icd10: DataFrame
    dim_icd9: DataFrame
    dim_icd10_procedure: DataFrame
    dim_stopcode: DataFrame
    dim_sta3n: DataFrame
    dim_state: DataFrame
    planned_conditions: DataFrame
    planned_procedures_always: DataFrame
    planned_procedures_sometimes: DataFrame

    @classmethod
    def from_directory(
        cls, spark: SparkSession, facts: str, dims: str | None = None
    ) -> SourceTables:
        """All relations as parquet; dimensions may live in a second directory."""
        return cls(**{
            name: read_source(spark, (dims or facts) if _is_dim(name) else facts, name, cols)
            for name, cols in COLUMNS.items()
        })

    @classmethod
    def from_catalog(
        cls, spark: SparkSession, schema: str, dim_schema: str | None = None
    ) -> SourceTables:
        """All relations as catalog tables; dimensions may live in a second schema."""
        homes = {True: dim_schema or schema, False: schema}
        return cls(**{
            name: spark.table(f"{homes[_is_dim(name)]}.{name}").select(*cols)
            for name, cols in COLUMNS.items()
        })
