"""Whole-table order without a whole-table task.

A window over the whole table, or over one huge group, is sorted by a single
task. Here the table is range-partitioned instead, each block is sorted by its
own task, and what crosses a block border is one row per block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import discard, store

# monotonically_increasing_id() puts the partition above 33 bits of row position.
POSITION_BITS = 33

BLOCK, POSITION = "_block", "_position"


def ordered_blocks(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows of ``df`` stored in order, each with its block and position in it.

    All columns take part in the order, after those given, so the order is a
    function of the rows alone. Rows that are copies of each other differ in a
    last number, so even a table of copies is cut into even blocks. The input
    is stored first: the range sampler reads it once more, and the last number
    must be the same for a task run again after a lost executor. That copy goes
    as soon as the ordered one is there.
    """
    order = [*order, *[c for c in df.columns if c not in order]]
    unordered = store(df, "unordered")
    rows = unordered.withColumn("_copy", F.monotonically_increasing_id())
    placed = (
        rows.repartitionByRange(*order, "_copy")
        .sortWithinPartitions(*order, "_copy")
        .drop("_copy")
        .withColumn("_place", F.monotonically_increasing_id())
    )
    place = F.col("_place")
    ordered = store(placed, "ordered")
    discard(unordered)
    return ordered.select(
        *df.columns,
        F.shiftright(place, POSITION_BITS).alias(BLOCK),
        place.bitwiseAND(F.lit((1 << POSITION_BITS) - 1)).alias(POSITION),
    )


def surrogate_key(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``df`` with a dense number 1..n in column ``name``, by ``order``.

    A row's number is its position plus the sizes of the blocks before; the
    table of block sizes has one row per block, so its broadcast is bounded by
    the number of shuffle partitions.
    """
    blocks = ordered_blocks(df, order)
    before = W.orderBy(BLOCK).rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        blocks.groupBy(BLOCK)
        .agg(F.count(F.lit(1)).alias("_size"))
        .select(BLOCK, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    return blocks.join(F.broadcast(offsets), BLOCK).select(
        (F.col("_offset") + F.col(POSITION) + 1).alias(name), *df.columns
    )


def following_value(
    df: DataFrame, group: str, order: Sequence[str], value: str, name: str
) -> DataFrame:
    """``df`` with the ``value`` of the next row of the same group in ``name``.

    Equal to LEAD over the group, but a group is handled block by block. The
    last row of a block looks at the first row of the next block.
    """
    blocks = ordered_blocks(df, [group, *order])
    in_block = W.partitionBy(BLOCK, group).orderBy(POSITION)
    inside = blocks.withColumn("_next", F.lead(F.struct(value)).over(in_block))
    # One row per block: the first row of each, filed under the block before it.
    seams = blocks.where(F.col(POSITION) == 0).select(
        F.lag(BLOCK).over(W.orderBy(BLOCK)).alias("_seam"),
        F.col(group).alias("_seam_group"),
        F.struct(value).alias("_seam_next"),
    )
    found = inside.join(
        F.broadcast(seams),
        (F.col(BLOCK) == F.col("_seam")) & F.col(group).eqNullSafe(F.col("_seam_group")),
        "left",
    )
    return found.select(
        *df.columns, F.coalesce("_next", "_seam_next").getField(value).alias(name)
    )
