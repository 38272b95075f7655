"""Exact distinct counts of dense keys by bitmaps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KIND, KEY, BUCKET, BITS = "_kind", "_key", "_bucket", "_bits"


def distinct_counts(
    df: DataFrame,
    keys: Mapping[str, str],
    sums: Mapping[str, Column] | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Distinct values of several key columns, and sums, per group, from one scan.

    A key sets one bit in the bitmap of its bucket of 32,768 numbers. Map tasks
    fill bitmaps, and what is shuffled is a bitmap of four kilobytes per group,
    key column and bucket, however many rows hold a key; a key that is common
    costs no more than a rare one. That suits surrogate keys, which are numbered
    without gaps. Every row is looked at once per key column inside the task;
    the sums go with the first of them. NULL is no key.
    """
    sums = dict(sums or {})

    def row(number: int, column: str) -> Column:
        measures = [
            (value if number == 0 else F.lit(None)).cast("long").alias(name)
            for name, value in sums.items()
        ]
        return F.struct(
            F.lit(number).alias(KIND), F.col(column).cast("long").alias(KEY), *measures
        )

    rows = df.select(*by, F.inline(F.array(*[row(k, c) for k, c in enumerate(keys.values())])))
    bitmaps = rows.groupBy(*by, KIND, F.bitmap_bucket_number(KEY).alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(KEY)).alias(BITS),
        *[F.sum(name).alias(name) for name in sums],
    )
    return bitmaps.groupBy(*by).agg(
        *[
            F.coalesce(F.sum(F.when(F.col(KIND) == k, F.bitmap_count(BITS))), F.lit(0)).alias(name)
            for k, name in enumerate(keys)
        ],
        *[F.sum(name).alias(name) for name in sums],
    )
