"""Run registered queries on Spark and on DuckDB and compare whole results."""

from __future__ import annotations

from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()

KINDS = {
    "VARCHAR": "string", "INTEGER": "int", "BIGINT": "bigint", "DATE": "date",
    "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def spark_result(df: DataFrame) -> tuple[dict[str, str], Counter]:
    names = sorted(df.columns)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return kinds, Counter(tuple(row) for row in df.select(*names).collect())


def duckdb_result(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[dict[str, str], Counter]:
    result = con.sql(sql)
    kinds = {
        name: KINDS.get(str(kind), str(kind).lower())
        for name, kind in zip(result.columns, result.types)
    }
    names = ", ".join(sorted(result.columns))
    return kinds, Counter(con.sql(f"SELECT {names} FROM ({sql})").fetchall())


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty text when columns, types and rows agree, else what differs."""
    kinds, rows = spark_result(df)
    expected_kinds, expected = duckdb_result(con, sql)
    if kinds != expected_kinds:
        return f"columns {kinds} are not {expected_kinds}"
    if rows != expected:
        return (
            f"{rows.total()} rows, {expected.total()} expected;"
            f" extra {list((rows - expected).items())[:3]},"
            f" missing {list((expected - rows).items())[:3]}"
        )
    return ""
