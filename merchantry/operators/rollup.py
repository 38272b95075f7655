"""Sums of fact measures by dimension attributes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def roll_up(
    fact: DataFrame,
    dimension: DataFrame,
    key: str,
    attributes: Sequence[str],
    measures: Mapping[str, str],
    by: Sequence[str] = (),
    members: str | None = None,
    label: Column | None = None,
) -> DataFrame:
    """Sum ``measures`` (output name to fact column) by attributes and ``by``.

    The fact is summed per surrogate key before the join. Map tasks combine
    first, so a key that holds a third of the fact is one row per map task in
    the shuffle, and the join meets each key once per value of ``by``: no fact
    row is shuffled and neither join side can be skewed. ``key`` is unique in
    the dimension. ``members`` names a column for the number of distinct
    dimension rows behind each result row; it needs an empty ``by``. ``label``
    is an expression over the attributes to group by in their place.
    """
    if members is not None and by:
        raise ValueError("members would be counted once per value of by")
    per_key = fact.groupBy(key, *by).agg(
        *[F.sum(column).alias(name) for name, column in measures.items()]
    )
    lookup = dimension.select(F.col(key).alias("_key"), *attributes)
    joined = per_key.join(lookup, per_key[key] == lookup["_key"], "left")
    sums = [F.sum(name).alias(name) for name in measures]
    if members is not None:
        sums.append(F.count("_key").alias(members))
    groups = attributes if label is None else [label]
    return joined.groupBy(*by, *groups).agg(*sums)
