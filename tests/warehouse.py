"""Small synthetic warehouses for Spark and the checking database alike."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import duckdb

from tallyward.sources.tables import COLUMNS, SourceTables

START = datetime(2000, 1, 1)
INT_COLUMNS = {"Sta3n", "StopCode"}


def column_type(name: str, sql: bool) -> str:
    if name.endswith("DateTime") or name == "DateDX":
        return "TIMESTAMP" if sql else "timestamp_ntz"
    if name in INT_COLUMNS:
        return "INTEGER" if sql else "int"
    if name.endswith("SID") or name == "OncologyPrimaryIEN":
        return "BIGINT" if sql else "bigint"
    return "VARCHAR" if sql else "string"


def to_spark(spark, rows: dict[str, list[tuple]]) -> SourceTables:
    return SourceTables(**{
        name: spark.createDataFrame(
            rows.get(name, []), ", ".join(f"{c} {column_type(c, False)}" for c in cols)
        ).coalesce(1)
        for name, cols in COLUMNS.items()
    })


def to_sql(rows: dict[str, list[tuple]]) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name, cols in COLUMNS.items():
        con.execute(f"CREATE TABLE {name} ({', '.join(f'{c} {column_type(c, True)}' for c in cols)})")
        if rows.get(name):
            con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(cols))})", rows[name])
    return con


def dimensions() -> dict[str, list[tuple]]:
    return {
        "dim_icd10": [(1, "C18.9"), (2, "XC20Y"), (3, "c19"), (4, "K35.8"), (5, "Z51.11"), (6, None), (7, "A00")],
        "dim_icd9": [(1, "153.4"), (2, "0153"), (3, "154.1"), (4, "154.2"), (5, None), (6, "1530")],
        "dim_icd10_procedure": [(1, "0DT.N0ZZ"), (2, "3E03305"), (3, "0D.BH8ZX"), (4, None)],
        "dim_stopcode": [(1, 323), (2, 301), (3, 107), (4, None), (5, 338), (6, 531)],
        "dim_sta3n": [(10, "Boston", 1), (11, "Houston", 2), (12, "Nowhere", None), (13, None, 3)],
        "dim_state": [(1, "MA"), (2, "TX")],
        "planned_conditions": [("Z5111",), ("A00",)],
        "planned_procedures_always": [("0DTN0ZZ",)],
        "planned_procedures_sometimes": [("0DBH8ZX ",)],
    }


def random_warehouse(seed: int, null_persons: bool) -> dict[str, list[tuple]]:
    """Few persons, few ids and few times, so that ties, collisions and fan-outs are common."""
    rng = random.Random(seed)
    pick = rng.choice
    sids = [-1, *range(1, 60)]
    persons = [f"{n:09d}" for n in range(35)] + ([None] if null_persons else [])
    offsets_days = [-9000, -400, -30, -29, -10, -1, 0, 0, 1, 5, 20, 29, 30, 31, 60, 61, 90, 200, 330, 365, 366, 367]

    def time(nulls: float = 0.02):
        if rng.random() < nulls:
            return None
        return START + timedelta(days=pick(offsets_days), hours=pick([0, 0, 0, 6, 23]), seconds=pick([0, 0, 1]))

    def ids(n: int, sentinel: float = 0.03):
        return -1 if rng.random() < sentinel else rng.randint(1, n)

    rows = dimensions()
    rows["spatient"] = [
        (s, pick(persons), pick([None, START + timedelta(days=500)]), pick(["M", "F", None]),
         pick([None, datetime(1940, 2, 29), datetime(1950, 12, 31, 23)]))
        for s in sids
    ]
    rows["spatient"].append((3, pick(persons), None, "F", datetime(1960, 7, 1)))  # a site id of two persons
    rows["patient_race"] = [
        (s, pick(["WHITE", "white ", "BLACK OR AFRICAN AMERICAN", "WHITE NOT OF HISP ORIG", "ASIAN", None]))
        for s in sids for _ in range(pick([0, 1, 1, 1, 2, 3]))
    ]
    rows["patient_ethnicity"] = [
        (s, pick(["HISPANIC OR LATINO", "NOT HISPANIC", None])) for s in sids for _ in range(pick([1, 1, 2]))
    ]
    stations = [10, 11, 12, 13, 14, None]
    rows["outpat_workload"] = [
        (ids(150), pick(sids), time(0.01), pick([1, 1, 2, 2, 3, 4, 5, 6, None]), pick(stations)) for _ in range(320)
    ]
    rows["outpat_workload_vdiagnosis"] = [
        (ids(150), pick([1, 2, 3, 4, 4, 4, 6, None, None]), pick([1, 2, 3, 4, 5, 6, None, None, None]))
        for _ in range(60)
    ]
    rows["inpat_inpatient"] = [(ids(120), pick(sids), time(), pick(stations)) for _ in range(220)]
    rows["inpat_inpatient_diagnosis"] = [
        (ids(120), pick([1, 2, 3, 4, 5, 5, 7, 4, None]), pick([1, 2, 4, 5, None, None, None])) for _ in range(50)
    ]
    rows["inpat_inpatient_icd_procedure"] = [(ids(120), pick([1, 2, 3, 4, None])) for _ in range(30)]
    rows["oncology_primary"] = [
        (pick(sids), ids(100), time(), pick(["ADENO", None, "small cell"]), pick(["COLON", "SKIN", None]),
         pick(["RECTUM", "LUNG", "colon", None]), pick([None, "Rectosigmoid", "LUNG"]),
         pick(["I", "II", "III", "IV", "i", "I ", "0", "NA", "Unk/Uns", None]), pick(stations))
        for _ in range(40)
    ]
    rows["edis_edislog"] = []
    for _ in range(160):
        arrival = time()
        end = None
        if arrival is not None and rng.random() > 0.1:
            end = arrival + timedelta(hours=pick([0, 1, 6]))
        rows["edis_edislog"].append((ids(150, 0.1), pick(sids), arrival, end, pick(stations)))
    return rows
