"""Profiles of tables and of their columns."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: number of rows and of columns."""
    return _union(
        [
            df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("table_name"),
                "n_rows",
                F.lit(len(df.columns)).alias("n_columns"),
            )
            for name, df in tables.items()
        ]
    )


def column_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column: type, non-null and distinct counts, extremes as text.

    The tables should be stored in a columnar format: each column is a scan of
    its own that reads nothing else. Several distinct counts in one aggregate
    would copy every row once per column. Map tasks combine first, so a value
    that fills a column is one row per map task in the shuffle.
    """
    return _union(
        [
            df.agg(
                F.count(field.name).alias("n_non_null"),
                F.count_distinct(field.name).alias("n_distinct"),
                F.min(field.name).cast("string").alias("min_value"),
                F.max(field.name).cast("string").alias("max_value"),
            ).select(
                F.lit(name).alias("table_name"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                "*",
            )
            for name, df in tables.items()
            for field in df.schema.fields
        ]
    )
