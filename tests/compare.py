"""Compare Spark results with the checking database, column by column name."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{directory}/{name}.parquet'")
    return con


def normal(value):
    return round(value, 6) if isinstance(value, float) else value


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(normal(row[n]) for n in names) for row in df.collect())


def sql_rows(con, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    order = sorted(range(len(columns)), key=columns.__getitem__)
    rows = Counter(tuple(normal(row[i]) for i in order) for row in result.fetchall())
    return [columns[i] for i in order], rows


# Spark type name to the database's
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP",
    "date": "DATE", "double": "DOUBLE", "boolean": "BOOLEAN",
}


def type_differences(df, con, sql: str) -> list[str]:
    described = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return [
        f"{name}: {kind} / {described.get(name)}"
        for name, kind in df.dtypes if TYPES.get(kind) != described.get(name)
    ]
