"""Links between the members of buckets, and the groups that links make.

Buckets may hold any number of members. All pairs of a bucket are never formed:
first each member is compared with the least of all least members of its
buckets, then with those of buckets in which it is still in another group, and
only members that are still apart after that are compared with each other, so no
link between groups is lost.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import discard, store

# Bits of the filter that rows are passed through before a shuffle: always four megabytes.
FILTER_BITS = 1 << 25

# Bits of one bitmap that Spark makes.
BITMAP_BITS = 1 << 15


def bitmap_words(bits: Column) -> Column:
    """A bitmap that Spark made as whole numbers of eight bytes each."""
    numbers = F.sequence(F.lit(0), F.lit(BITMAP_BITS // 64 - 1))
    return F.transform(
        numbers,
        lambda k: F.conv(F.hex(F.substring(bits, k * 8 + 1, F.lit(8))), 16, -10).cast("long"),
    )


def parted(
    rows: DataFrame, column: str, wanted: DataFrame, wanted_column: str
) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose hash in ``column`` may be among those of ``wanted``, and those that are not.

    The hashes wanted become a bitmap of fixed size, built in the map tasks and
    broadcast; it lets pass all rows that are wanted and others by chance, more
    of them the more are wanted. So texts that nobody asks for are not shuffled
    in a join. The bits are looked up in arrays of whole numbers, of which a row
    reads one; of a binary column each row would copy all bytes.
    """
    place = F.pmod(F.col(wanted_column), F.lit(FILTER_BITS))
    bitmap = store(
        wanted.select(
            F.bitmap_bucket_number(place).alias("_bucket"), F.bitmap_bit_position(place).alias("_at")
        )
        .groupBy("_bucket")
        .agg(F.bitmap_construct_agg("_at").alias("_bits"))
        .select("_bucket", bitmap_words(F.col("_bits")).alias("_words")),
        "filter",
    )
    here = F.pmod(F.col(column), F.lit(FILTER_BITS))
    marked = rows.withColumns(
        {
            "_part": F.bitmap_bucket_number(here),
            "_position": F.bitmap_bit_position(here).cast("int"),
        }
    )
    word = F.get("_words", F.call_function("shiftright", F.col("_position"), F.lit(6)))
    # Of a word, bytes come from the highest on, and bits of a byte from the lowest on.
    bit = F.col("_position").bitwiseAND(F.lit(63)).bitwiseXOR(F.lit(56))
    found = marked.join(F.broadcast(bitmap), F.col("_part") == F.col("_bucket"), "left").withColumn(
        "_wanted",
        F.coalesce(F.call_function("shiftright", word, bit).bitwiseAND(F.lit(1)) != 0, F.lit(False)),
    )
    return (
        found.where("_wanted").select(*rows.columns),
        found.where("NOT _wanted").select(*rows.columns),
    )


def components(links: DataFrame) -> DataFrame:
    """``id`` and the least id reachable, ``component``, of all ids in ``links`` (a, b).

    Alternates two steps until nothing changes: every id hands its larger
    neighbours to the least one, then its smaller ones. Each step reads and
    writes a stored table, so lost executors cost a step at most; tables of the step
    before go. An id with
    very many links is a hot key only in a join with a stored table, which
    Spark splits.
    """
    edges = store(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b")
        .distinct(),
        "links",
    )

    def mark(df: DataFrame) -> tuple:
        row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 31))).first()
        return tuple(row)

    state = mark(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = store(
            both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("m")),
            "least",
        )
        large = store(
            both.join(least, F.col("a") == F.col("id"))
            .where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct(),
            "links",
        )
        discard(edges)
        discard(least)
        # Each id now has smaller neighbours only.
        least = store(large.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")), "least")
        edges = store(
            large.join(least, F.col("a") == F.col("id"))
            .where(F.col("b") != F.col("m"))
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select(F.col("id").alias("a"), F.col("m").alias("b")))
            .distinct(),
            "links",
        )
        discard(large)
        discard(least)
        previous, state = state, mark(edges)
        if state == previous:
            break
    found = edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component"))
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return store(found.union(roots), "components")


def shared_buckets(keys: DataFrame) -> DataFrame:
    """Rows (key, id, leader) of all buckets of several ids, the least of which leads, but its own."""
    buckets = store(
        keys.groupBy("key")
        .agg(F.min("id").alias("leader"), F.max("id").alias("last"))
        .where("leader <> last")
        .select("key", "leader"),
        "buckets",
    )
    # Most keys are of one id alone; these are not shuffled again.
    likely, _ = parted(keys, "key", buckets, "key")
    return store(likely.join(buckets, "key").where("id <> leader").distinct(), "members")


def bucket_links(
    keys: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    links_of: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Links (a, b) that ``verify`` leaves of the pairs sharing a bucket, enough for all groups.

    ``keys`` has a row (key, id) per bucket an id is in; repeats do no harm. It may
    be what :func:`shared_buckets` made of them. ``verify`` takes pairs (a, b) and
    returns those that are links. Pairs whose ids are in one group already are not
    looked at again. What is left in buckets of several groups goes to ``links_of``
    as rows (key, id, component); it returns the links between different
    components, by default those that ``verify`` leaves of :func:`crossing_pairs`.
    """
    members = keys if "leader" in keys.columns else shared_buckets(keys)
    # First each id is compared with the least leader of all its buckets, whatever their number.
    least = members.groupBy(F.col("id").alias("a")).agg(F.min("leader").alias("b"))
    links = store(verify(store(least, "pairs")), "links")
    groups = components(links)

    def labelled(groups: DataFrame) -> DataFrame:
        return store(
            members.join(groups, "id", "left").select(
                "key", "id", "leader", F.coalesce("component", "id").alias("component")
            ),
            "labelled",
        )

    # Then with the leaders of those buckets in which it is still in another group.
    found = labelled(groups)
    heads = groups.select(F.col("id").alias("head"), F.col("component").alias("head_component"))
    apart = (
        found.join(heads, F.col("leader") == F.col("head"), "left")
        .where(F.col("component") != F.coalesce("head_component", "leader"))
        .select(F.col("id").alias("a"), F.col("leader").alias("b"))
        .distinct()
    )
    tried = store(
        least.select("a", "b", F.lit(True).alias("tried")), "tried"
    )
    again = store(
        apart.join(tried, ["a", "b"], "left").where("tried IS NULL").select("a", "b"), "pairs"
    )
    if not again.isEmpty():
        links = store(links.union(verify(again)), "links")
        found = labelled(components(links))
    # Who shares a bucket with another group; of a bucket's own leader all is known.
    several = (
        found.select("key", "component")
        .distinct()
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("groups"))
        .where("groups > 1")
        .select("key")
    )
    mixed = store(found.drop("leader").join(several, "key"), "mixed-members")
    if mixed.isEmpty():
        return links
    if links_of:
        return links.union(links_of(mixed))
    return links.union(verify(store(crossing_pairs(mixed).distinct(), "pairs")))


def crossing_pairs(mixed: DataFrame) -> DataFrame:
    """All pairs (a, b) of one key and different components."""
    parts = store(mixed.select("key", "component").distinct(), "bucket-groups")
    crossing = parts.select("key", F.col("component").alias("x")).join(
        parts.select("key", F.col("component").alias("y")), "key"
    ).where("x < y")
    left = mixed.select(*[F.col(c).alias(f"a_{c}") for c in mixed.columns])
    right = mixed.select(*[F.col(c).alias(f"b_{c}") for c in mixed.columns])
    here = (F.col("key") == F.col("b_key")) & (F.col("y") == F.col("b_component"))
    return (
        crossing.join(left, (F.col("key") == F.col("a_key")) & (F.col("x") == F.col("a_component")))
        .join(right, here)
        .select(F.greatest("a_id", "b_id").alias("a"), F.least("a_id", "b_id").alias("b"))
    )
