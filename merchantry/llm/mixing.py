"""Mixing sources to target weights by Pareto order sampling.

A document is wanted ``target / size`` times, as its source is. The whole part
of that is certain; the fraction is its inclusion odds in a Pareto sample:
documents are ranked by random odds over inclusion odds, and the first ones
are taken until the rest of the target is reached. Given weights, the wanted
number of copies of a document follows them, so odds differ inside a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.ordering import BLOCK, POSITION, ordered_blocks, surrogate_key
from ..session import store
from .common import WORD, spare

MOST_COPIES = 3
WEIGHTS = (1, 2, 3)


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES
) -> DataFrame:
    """A row per source of ``sizes`` (source, size): source_size and target.

    Sources weigh by code point order, NULL last, the weights repeating. They
    share the sum of all sizes; a target stops at ``most`` times the source's
    size and the excess is shared anew. Each round is one aggregate over the
    table of sources; only sums come to the driver.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = surrogate_key(
        totals.select(
            F.col("source").isNull().alias("last"), "source", "source_size"
        ),
        ["last", "source"],
        "number",
    )
    place = ((F.col("number") - 1) % len(weights)).cast("int")
    weighed = store(
        numbered.select(
            "source",
            "source_size",
            F.element_at(F.array(*map(F.lit, weights)), place + 1).cast("long").alias("weight"),
        ),
        "source-weights",
    )
    cap = F.col("source_size") * most
    share, total = 0.0, None
    while True:
        stopped = F.col("weight") * F.lit(share) > cap
        row = weighed.agg(
            F.sum("source_size").alias("total"),
            F.coalesce(F.sum(F.when(stopped, cap)), F.lit(0)).alias("capped"),
            F.coalesce(F.sum(F.when(~stopped, F.col("weight"))), F.lit(0)).alias("open"),
        ).first()
        total = row["total"] or 0
        new = (total - row["capped"]) / row["open"] if row["open"] else share
        if new == share:
            break
        share = new
    target = F.when(F.col("weight") * F.lit(share) > cap, cap.cast("double")).otherwise(
        F.col("weight") * F.lit(share)
    )
    return weighed.select("source", "source_size", target.cast("double").alias("target"))


def uniform(*seed: Column) -> Column:
    """A number inside (0, 1) that is a function of ``seed``: 52 bits of an MD5."""
    digits = F.substring(F.md5(F.concat_ws("|", *seed)), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(2**52))


def running_before(rows: DataFrame, group: str, order: list[str], amount: str, name: str) -> DataFrame:
    """``rows`` with the sum of ``amount`` over rows before, inside ``group`` by ``order``.

    The whole order is cut into even blocks, so a hot group is many tasks; sums
    of blocks, one row each, carry over.
    """
    blocks = ordered_blocks(rows, [group, *order])
    inside = W.partitionBy(BLOCK).orderBy(POSITION).rowsBetween(W.unboundedPreceding, -1)
    before = W.orderBy(BLOCK).rowsBetween(W.unboundedPreceding, -1)
    offsets = blocks.groupBy(BLOCK).agg(F.sum(amount).alias("_sum")).select(
        BLOCK, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset")
    )
    placed = blocks.join(F.broadcast(offsets), BLOCK).select(
        *rows.columns,
        (F.col("_offset") + F.coalesce(F.sum(amount).over(inside), F.lit(0))).alias("_all"),
    )
    placed = store(placed, "running")
    # Stored, so that Spark knows its size and can split a hot group in the join.
    starts = store(
        placed.groupBy(F.col(group).alias("_group")).agg(F.min("_all").alias("_start")), "starts"
    )
    return placed.join(starts, F.col(group).eqNullSafe(F.col("_group"))).select(
        *rows.columns, (F.col("_all") - F.col("_start")).alias(name)
    )


def mix(
    sizes: DataFrame,
    targets: DataFrame,
    weight: str | None = None,
    seed: str = "mix",
) -> DataFrame:
    """``sizes`` (doc_id, source, size, row) with source_size, target and ``copies``.

    ``row`` tells rows apart and, with ``doc_id``, fixes the random numbers, so
    that runs agree. Copies of a source come to its target to within half of
    the document on the border. A source without words takes nothing.
    """
    known = sizes.join(targets, sizes["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    if weight is None:
        wanted = F.col("target") / F.col("source_size")
    else:
        sums = store(
            sizes.groupBy(F.col("source").alias("_s")).agg(
                F.sum(F.col(weight) * F.col("size")).alias("_w")
            ),
            "weighted-sizes",
        )
        known = known.join(sums, known["source"].eqNullSafe(F.col("_s"))).drop("_s")
        # No document is wanted more often than the limit, whatever it weighs.
        wanted = F.least(F.col(weight) * F.col("target") / F.col("_w"), F.lit(float(MOST_COPIES)))
    known = known.withColumn("_wanted", F.when(F.col("source_size") > 0, wanted).otherwise(F.lit(0.0)))
    whole = F.floor("_wanted")
    odds = F.col("_wanted") - whole
    u = uniform(F.lit(seed), F.col("doc_id").cast("string"), F.col("row").cast("string"))
    rank = F.when(odds > 0, (u / (1 - u)) / (odds / (1 - odds)))
    ranked = known.withColumns({"_whole": whole.cast("int"), "_rank": rank})
    # Words the certain copies take, and what is left of the target.
    certain = store(
        ranked.groupBy(F.col("source").alias("_src")).agg(
            F.sum(F.col("_whole") * F.col("size")).alias("_certain")
        ),
        "certain-copies",
    )
    drawn = running_before(
        ranked.where(F.col("_rank").isNotNull() & (F.col("size") > 0)),
        "source",
        ["_rank", "doc_id", "row"],
        "size",
        "_before",
    )
    rest = F.col("target") - F.col("_certain")
    # The document on the border is taken if that comes nearer to the target.
    taken = F.col("_before") + F.col("size") / 2 <= rest
    chosen = drawn.join(certain, F.col("source").eqNullSafe(F.col("_src"))).select(
        *sizes.columns, "source_size", "target", (F.col("_whole") + taken.cast("int")).alias("copies")
    )
    plain = ranked.where(F.col("_rank").isNull() | (F.col("size") == 0)).select(
        *sizes.columns, "source_size", "target", F.col("_whole").alias("copies")
    )
    return chosen.unionByName(plain)


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words and MD5 of the text (``row``) of every document; stored."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).cast("long")
    return store(
        docs.select("doc_id", "source", size.alias("size"), F.md5(text.cast("binary")).alias("row")),
        "sizes",
    )


def mix_documents(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken words of every document.

    A NULL text has no words and is taken no times; NULL is a source. Rows
    equal in id and text draw one random number and follow each other in the
    order; each gives a row. Other columns are ignored. No rows give no rows.
    """
    sizes = document_sizes(docs)
    return mix(sizes, source_targets(sizes.select("source", "size"))).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed_rows(docs: DataFrame) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken.

    Needs ``doc_id``, ``text`` and ``source``; all columns are kept. Documents
    without words are in no mix. Rows equal in the three share their copies
    out evenly.
    """
    a, b, copies, rows, place = spare(docs, "key_a", "key_b", "copies", "rows", "place")
    sizes = document_sizes(docs)
    chosen = (
        mix(sizes, source_targets(sizes.select("source", "size")))
        .groupBy(F.xxhash64("doc_id", "source").alias(a), F.col("row").alias(b))
        .agg(F.sum("copies").alias(copies), F.count(F.lit(1)).alias(rows))
        .where(F.col(copies) > 0)
    )
    keyed = docs.withColumns(
        {
            a: F.xxhash64("doc_id", "source"),
            b: F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")),
        }
    )
    order = W.partitionBy(a, b).orderBy(a)
    share = F.floor(F.col(copies) / F.col(rows)) + (
        F.col(place) <= F.col(copies) % F.col(rows)
    ).cast("long")
    each = keyed.join(chosen, [a, b]).withColumn(place, F.row_number().over(order))
    return (
        each.withColumn(copies, share)
        .where(F.col(copies) > 0)
        .withColumn(place, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))))
        .select(*[f"`{c}`" for c in docs.columns])
    )
