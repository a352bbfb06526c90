"""The warehouse relations as role views over the generic star-schema tables.

Each view is a list of legs (table, condition, columns). The expressions are
kept to what Spark SQL and the checking database both understand, so one text
serves as input to both. ``{TS}`` stands for the zone-less timestamp type.

A customer is a site id and two neighbouring customers are one person. An order
is a visit, a stay, an emergency visit or a registry entry (or several of them:
the id spaces overlap); its line items are diagnoses and procedures. Parts and
suppliers are the coding systems, nations the stations, regions the states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyward.operators.setops import union_events
from tallyward.sources.tables import SourceTables

_ICD10 = (
    "CASE WHEN p_name LIKE '%ring' AND p_type = 'PROMO'"
    " THEN concat('C18.', CAST(p_size % 10 AS STRING))"
    " WHEN p_name LIKE '%bolt' AND p_type = 'SMALL'"
    " THEN concat('C34.', CAST(p_size % 10 AS STRING))"
    " ELSE concat(chr(CAST(68 + p_partkey % 20 AS INT)), lpad(CAST(p_size AS STRING), 2, '0'),"
    " '.', CAST(p_partkey % 10 AS STRING)) END"
)
_PROCEDURE = (
    "concat('0', substr(p_type, 1, 1), lpad(CAST(p_size AS STRING), 2, '0'), '.',"
    " lpad(CAST(p_partkey % 1000 AS STRING), 3, '0'))"
)
_STATION = "CAST((o_custkey + o_orderkey) % 25 AS INT) AS Sta3n"

ROLES: dict[str, list[tuple[str, str, tuple[str, ...]]]] = {
    "spatient": [("customer", "TRUE", (
        "c_custkey AS PatientSID",
        "lpad(CAST(CAST(floor(c_custkey / 2) AS BIGINT) AS STRING), 9, '0') AS PatientSSN",
        "CASE WHEN c_acctbal < 1000 THEN CAST('2001-03-01 00:00:00' AS {TS})"
        " + INTERVAL '1' DAY * CAST(c_custkey % 300 AS INT) END AS DeathDateTime",
        "CASE WHEN c_nationkey % 2 = 0 THEN 'M' ELSE 'F' END AS Gender",
        "CAST('1925-01-15 00:00:00' AS {TS})"
        " + INTERVAL '1' DAY * CAST(c_custkey * 37 % 18000 AS INT) AS BirthDateTime",
    ))],
    "patient_race": [
        ("customer", "c_nationkey <> 3", (
            "c_custkey AS PatientSID",
            "CASE c_mktsegment WHEN 'MACHINERY' THEN 'WHITE'"
            " WHEN 'BUILDING' THEN 'BLACK OR AFRICAN AMERICAN'"
            " WHEN 'AUTOMOBILE' THEN 'WHITE NOT OF HISP ORIG'"
            " WHEN 'FURNITURE' THEN 'ASIAN' END AS Race",
        )),
        ("customer", "c_nationkey = 7", ("c_custkey AS PatientSID", "'WHITE' AS Race")),
    ],
    "patient_ethnicity": [("customer", "TRUE", (
        "c_custkey AS PatientSID",
        "CASE c_nationkey % 5 WHEN 1 THEN 'HISPANIC OR LATINO' WHEN 2 THEN NULL"
        " ELSE 'NOT HISPANIC OR LATINO' END AS Ethnicity",
    ))],
    "outpat_workload": [("orders", "o_orderstatus <> 'F'", (
        "o_orderkey AS VisitSID", "o_custkey AS PatientSID", "o_orderdate AS VisitDateTime",
        "CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS PrimaryStopCodeSID", _STATION,
    ))],
    "outpat_workload_vdiagnosis": [("lineitem", "l_linestatus = 'O'", (
        "l_orderkey AS VisitSID",
        "CASE WHEN l_quantity <= 45 THEN l_partkey END AS ICD10SID",
        "CASE WHEN l_quantity > 45 THEN l_suppkey END AS ICD9SID",
    ))],
    "inpat_inpatient": [("orders", "o_orderstatus = 'F'", (
        "o_orderkey AS InpatientSID", "o_custkey AS PatientSID",
        "o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey % 48 AS INT) AS AdmitDateTime", _STATION,
    ))],
    "inpat_inpatient_diagnosis": [("lineitem", "l_linestatus = 'F'", (
        "l_orderkey AS InpatientSID",
        "CASE WHEN l_quantity <= 45 THEN l_partkey END AS ICD10SID",
        "CASE WHEN l_quantity > 45 THEN l_suppkey END AS ICD9SID",
    ))],
    "inpat_inpatient_icd_procedure": [("lineitem", "l_returnflag = 'R'", (
        "l_orderkey AS InpatientSID", "l_partkey AS ICD10ProcedureSID",
    ))],
    "oncology_primary": [("orders", "o_orderpriority = '1-URGENT'", (
        "o_custkey AS PatientSID", "o_orderkey AS OncologyPrimaryIEN", "o_orderdate AS DateDX",
        "CASE o_orderkey % 5 WHEN 0 THEN 'ADENOCARCINOMA' WHEN 1 THEN 'SMALL CELL'"
        " WHEN 2 THEN 'CARCINOID' WHEN 3 THEN 'SARCOMA NOS' END AS Histologyicdo3X",
        "CASE WHEN o_orderkey % 13 = 0 THEN 'RECTUM NOS' WHEN o_orderkey % 13 = 1 THEN 'LUNG'"
        " ELSE 'SKIN' END AS ICDOSite",
        "CASE o_orderkey % 11 WHEN 0 THEN 'COLON' WHEN 1 THEN 'LUNG & BRONCHUS'"
        " ELSE 'PROSTATE GLAND' END AS SitegpX",
        "CASE o_orderkey % 17 WHEN 0 THEN 'colon, sigmoid' WHEN 1 THEN 'lung, upper lobe' END"
        " AS PrimarysiteX",
        "CASE o_orderkey % 8 WHEN 0 THEN 'I' WHEN 1 THEN 'II' WHEN 2 THEN 'III' WHEN 3 THEN 'IV'"
        " WHEN 4 THEN 'Unk/Uns' WHEN 5 THEN 'NA' WHEN 6 THEN '0' END AS StageGroupingajcc",
        _STATION,
    ))],
    "edis_edislog": [("orders", "o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')", (
        "CASE WHEN o_orderkey % 13 = 0 THEN CAST(-1 AS BIGINT) ELSE o_orderkey END AS VisitSID",
        "o_custkey AS PatientSID",
        "o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey % 24 AS INT) AS PatientArrivalDateTime",
        "CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate"
        " + INTERVAL '1' HOUR * CAST(o_orderkey % 24 + 1 + o_orderkey % 7 AS INT) END"
        " AS DispositionDateTime",
        _STATION,
    ))],
    "dim_icd10": [("part", "TRUE", ("p_partkey AS ICD10SID", f"{_ICD10} AS ICD10Code"))],
    "dim_icd9": [("supplier", "TRUE", (
        "s_suppkey AS ICD9SID",
        "CASE WHEN s_name LIKE '%3' THEN concat('153.', CAST(s_suppkey % 10 AS STRING))"
        " WHEN s_name LIKE '%7' THEN '162.9'"
        " ELSE concat(CAST(200 + s_suppkey % 700 AS STRING), '.0') END AS ICD9Code",
    ))],
    "dim_icd10_procedure": [("part", "TRUE", (
        "p_partkey AS ICD10ProcedureSID", f"{_PROCEDURE} AS ICD10ProcedureCode",
    ))],
    "dim_stopcode": [("nation", "TRUE", (
        "CAST(n_nationkey AS BIGINT) AS StopCodeSID",
        "CASE n_nationkey WHEN 1 THEN 107 WHEN 2 THEN 323 WHEN 3 THEN 301 WHEN 4 THEN NULL"
        " ELSE 500 + n_nationkey END AS StopCode",
    ))],
    "dim_sta3n": [("nation", "TRUE", (
        "n_nationkey AS Sta3n", "n_name AS City",
        "CASE WHEN n_regionkey <> 4 THEN CAST(n_regionkey AS BIGINT) END AS StateSID",
    ))],
    "dim_state": [("region", "TRUE", (
        "CAST(r_regionkey AS BIGINT) AS StateSID", "r_name AS State",
    ))],
    "planned_conditions": [("part", "p_type = 'ECONOMY' AND p_size <= 10", (
        f"replace({_ICD10}, '.', '') AS code",
    ))],
    "planned_procedures_always": [("part", "p_type = 'LARGE' AND p_size <= 5", (
        f"replace({_PROCEDURE}, '.', '') AS code",
    ))],
    "planned_procedures_sometimes": [("part", "p_type = 'MEDIUM' AND p_size <= 5", (
        f"replace({_PROCEDURE}, '.', '') AS code",
    ))],
}


def role_views(spark: SparkSession, directory: str) -> SourceTables:
    """The role views as lazy DataFrames over the parquet tables of a directory."""
    # each table is opened once, since opening reads file footers
    tables = {
        name: spark.read.parquet(f"{directory}/{name}.parquet")
        for name in {table for legs in ROLES.values() for table, _, _ in legs}
    }

    def leg(table: str, condition: str, columns: tuple[str, ...]) -> DataFrame:
        rows = tables[table] if condition == "TRUE" else tables[table].where(condition)
        return rows.selectExpr(*(c.replace("{TS}", "TIMESTAMP_NTZ") for c in columns))

    return SourceTables(**{
        name: union_events(*(leg(*parts) for parts in legs)) for name, legs in ROLES.items()
    })


def role_ctes() -> str:
    """The same views as common table expressions for the checking database."""
    views = []
    for name, legs in ROLES.items():
        body = " UNION ALL ".join(
            f"SELECT {', '.join(columns)} FROM {table} WHERE {condition}"
            for table, condition, columns in legs
        )
        views.append(f"{name} AS ({body.replace('{TS}', 'TIMESTAMP')})")
    return ",\n".join(views)
