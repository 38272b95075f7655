"""Small builders for literal test rows."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, SparkSession

from merchantry.schemas import BRONZE, GOLD


def rows_of(df: DataFrame) -> list[tuple]:
    return [tuple(row) for row in df.collect()]


def counted(df: DataFrame) -> Counter:
    return Counter(rows_of(df.select(*sorted(df.columns))))


def bronze_rows(spark: SparkSession, table: str, *rows: dict) -> DataFrame:
    """Raw rows; columns left out are NULL."""
    names = BRONZE[table].fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], BRONZE[table])


def gold_rows(spark: SparkSession, table: str, *rows: dict) -> DataFrame:
    """Rows of a star-schema table; columns left out are NULL."""
    names = GOLD[table].fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], GOLD[table])


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan_of(df: DataFrame) -> str:
    """The plan adaptive execution ended up with."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    return execution.executedPlan().toString()
