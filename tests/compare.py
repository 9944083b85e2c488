"""Exact comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Spark type -> DuckDB types that mean the same.
SAME_TYPE = {
    "string": {"VARCHAR"},
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "double": {"DOUBLE"},
    "date": {"DATE"},
    "timestamp_ntz": {"TIMESTAMP"},
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def duck_rows(con, sql: str):
    result = con.execute(sql)
    columns = [(d[0], str(d[1])) for d in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i][0])
    rows = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    return [columns[i] for i in order], rows


def spark_rows(df):
    names = sorted(df.columns)
    columns = [(name, df.schema[name].dataType.simpleString()) for name in names]
    table = df.select(*[f"`{name}`" for name in names]).toArrow()
    rows = Counter(zip(*[column.to_pylist() for column in table.columns]))
    return columns, rows
