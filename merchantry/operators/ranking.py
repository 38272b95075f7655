"""Row numbers used as filters.

Each ranking orders by unique trailing columns, so that ties cannot make two
runs differ. ``row_number`` followed by a bound on it is planned as a group
limit in the map tasks, so a group of any size reaches the shuffle as no more
than ``n`` rows per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def top_n_per_group(
    df: DataFrame, group: Sequence[str | Column], order: Sequence[Column | str], n: int, rank: str
) -> DataFrame:
    """The first ``n`` rows of each group, with their number in column ``rank``."""
    numbered = df.withColumn(rank, F.row_number().over(W.partitionBy(*group).orderBy(*order)))
    return numbered.where(F.col(rank) <= n)


def latest_per_key(df: DataFrame, key: str, recency: str) -> DataFrame:
    """One row per key: the latest by ``recency``, other columns break ties."""
    rest = [c for c in df.columns if c not in (key, recency)]
    return top_n_per_group(df, [key], [F.desc(recency), *rest], 1, "_rank").drop("_rank")


def top_n(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows of the table."""
    return df.orderBy(*order).limit(n)
