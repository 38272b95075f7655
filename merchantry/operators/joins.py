"""Left outer lookup that survives hot keys on either side."""

from __future__ import annotations

import warnings
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A group of this many lookup rows is still an ordinary amount of work for one task.
MODEST_GROUP = 1_000_000

# Items a sketch tracks per key that can be hot, and at most: what Spark allows.
TRACKED_PER_KEY = 16
MOST_TRACKED = 1_000_000

# Sketches of map tasks are merged in this many groups, one task each.
MERGERS = 64


def hot_keys(df: DataFrame, key: str, modest_group: int = MODEST_GROUP) -> dict[object, int]:
    """Values of ``key`` with more rows than one task should get, and how many, about.

    One pass with frequent-items sketches: what is shuffled is one sketch per
    map task, not the keys. There are at most ``rows / modest_group`` hot keys,
    and the sketches are sized by that, so the limit is the same for tables of
    every size; MERGERS rows of about as many items come to the driver. A table
    of few rows has no such key, and a count reads next to nothing.
    """
    rows = df.count()
    if rows <= modest_group:
        return {}
    keys = min(2 * -(-rows // modest_group), MOST_TRACKED // TRACKED_PER_KEY)
    frequent = F.call_function(
        "approx_top_k", F.col(key), F.lit(keys), F.lit(TRACKED_PER_KEY * keys)
    ).alias("frequent")
    groups = df.groupBy(F.spark_partition_id() % MERGERS).agg(F.count(key).alias("rows"), frequent)
    counts = Counter()
    for group in groups.collect():
        for found in group["frequent"]:
            counts[found["item"]] += found["count"]
    return {value: count for value, count in counts.items() if count > modest_group}


def _expects_skew_join(df: DataFrame) -> None:
    """Warns where the session would leave a hot key of the left side to one task."""
    for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled"):
        if df.sparkSession.conf.get(key).lower() != "true":
            warnings.warn(f"{key} is off: hot keys are not split", stacklevel=3)


def left_lookup(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    modest_group: int = MODEST_GROUP,
) -> DataFrame:
    """``left`` with the matching rows of ``right``; unmatched rows get NULLs.

    Spark chooses broadcast or shuffle by the size it knows or measures. A hot
    key on the left is split by the adaptive skew join, which can divide the
    preserved side of an outer join but never the other. So hot keys on the
    right are looked for first. Rows of such keys are sure to match, hence an
    inner join is exact for them and both sides can be spread: the right rows
    over slices, the left rows copied to every slice. A key the sketch did not
    report is joined the ordinary way, so the result never depends on it.

    The number of slices is at most that of shuffle partitions; Spark divides
    larger ones of the inner join further. ``right`` should come from stored
    tables by row-wise steps, so that a task run again deals its rows to the
    same slices.
    """
    _expects_skew_join(left)
    hot = hot_keys(right, right_key, modest_group)
    if not hot:
        return left.join(right, left[left_key] == right[right_key], "left")

    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = max(2, min(tasks, -(-max(hot.values()) // modest_group)))

    def is_hot(column: str) -> Column:
        return F.coalesce(F.col(column).isin(list(hot)), F.lit(False))

    left_cold, right_cold = left.where(~is_hot(left_key)), right.where(~is_hot(right_key))
    cold = left_cold.join(right_cold, left_cold[left_key] == right_cold[right_key], "left")

    right_hot = right.where(is_hot(right_key)).withColumn(
        "_right_slice", F.monotonically_increasing_id() % slices
    )
    left_hot = left.where(is_hot(left_key)).withColumn(
        "_left_slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))
    )
    spread = left_hot.join(
        right_hot,
        (left_hot[left_key] == right_hot[right_key])
        & (left_hot["_left_slice"] == right_hot["_right_slice"]),
    ).drop("_left_slice", "_right_slice")
    return cold.unionByName(spread)
