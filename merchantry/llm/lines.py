"""Fuzzy line deduplication.

Lines are normalised; equal ones are one node from the start. The SimHash of a
line is taken by stretches of five words: a block of 64 bits is the majority
vote of hashes of its words. Blocks are counted from both ends, and a line has two more
than the edits its length allows, so whatever words are replaced, two lines that
are alike share a block, mostly two; two blocks more lie around the word of the
least hash, for lines in which words were put in or left out. Lines too short for that share what is left
of their words without one. Lines are joined on all of these, and whoever shares
one is verified by edit similarity of words. Before a pair of lines is made, its
lengths and 128 parities of word hashes must allow that few words differ, which
rules out unlike lines only: a word that is replaced turns two parities at most.
Of every connected group one occurrence is kept, the first by document and line.

All of it is built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import store
from .clusters import bucket_links, components, parted, shared_buckets
from .common import spare

# Words to an edit: lines are alike if at most a tenth of the words of the longer one, rounded,
# is replaced, put in or left out.
WORDS_PER_EDIT = 10

# Words of a block.
STRETCH = 5

# Shorter lines have no blocks that are apart, longer ones no keys of all words but one.
LEAST_BLOCKED, MOST_RESTED = 13, 14

# Keys of a line that are carried beside it, so that a pair is looked at in one bucket alone.
KEYS_HELD = 256

# Lines of a bucket that a task compares with all others of it.
CHUNK = 512


def normalised(line: Column) -> Column:
    """Lower case, digits as 0, anything else than letters and digits as one space."""
    words = F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " ")
    return F.trim(F.regexp_replace(words, r"\p{N}", "0"))


def edits(n_words: Column) -> Column:
    """Word edits that a line of so many words allows: none below five, one below fifteen."""
    return F.floor((n_words + WORDS_PER_EDIT // 2) / WORDS_PER_EDIT).cast("int")


def simhash(five: Column) -> Column:
    """64 bits of the hashes of five words: the majority vote of their first two, the middle one
    and the last two, each hashed with its place, so that a word that is repeated counts apart."""
    a = F.xxhash64(F.get(five, 0), F.get(five, 1))
    b = F.xxhash64(F.get(five, 3), F.get(five, 4), F.lit(3))
    c = F.xxhash64(F.get(five, 2), F.lit(2))
    return a.bitwiseAND(b).bitwiseOR(c.bitwiseAND(a.bitwiseXOR(b)))


def least_word(hashes: Column) -> Column:
    """Place, from 1, of the word of the least hash."""
    return F.array_position(hashes, F.array_min(hashes)).cast("int")


def block_keys(hashes: Column, n: Column, at: Column) -> Column:
    """Keys of the SimHash blocks of a line: which one from which end, and its bits.

    ``at`` is :func:`least_word`. Give columns, as they are read several times.
    """

    def blocks(count: Column, start) -> Column:
        numbers = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(
            F.array().cast("array<int>")
        )
        return F.transform(numbers, lambda k: F.slice(hashes, start(k), F.lit(STRETCH)))

    def keys(found: Column, side: int) -> Column:
        return F.transform(found, lambda five, k: F.xxhash64(simhash(five), F.lit(side), k))

    count = edits(n) + 2
    left = blocks(F.ceil(count / 2).cast("int"), lambda k: STRETCH * k + 1)
    right = blocks(F.floor(count / 2).cast("int"), lambda k: n - STRETCH * (k + 1) + 1)
    # Words put in or left out near both ends move all of these; two more stretches go by the
    # word of the least hash, wherever it is, one from it on and one up to it.
    around = F.array(
        F.slice(hashes, at, F.lit(STRETCH)),
        F.slice(hashes, F.greatest(at - STRETCH + 1, F.lit(1)), F.least(at, F.lit(STRETCH))),
    )
    whole = F.transform(
        around, lambda five: F.when(F.size(five) == STRETCH, simhash(five))
    )
    anchored = F.transform(
        F.array_compact(whole), lambda bits: F.xxhash64(bits, F.lit(2))
    )
    return F.concat(keys(left, 0), keys(right, 1), anchored)


def rest_keys(hashes: Column) -> Column:
    """Keys of a short line: all its words, and all but one, for each of them."""
    rest = F.transform(hashes, lambda x: F.xxhash64(x, F.lit("rest")))

    def keys(h: Column) -> Column:
        every = F.aggregate(h, F.lit(0).cast("long"), lambda total, x: total.bitwiseXOR(x))
        return F.transform(
            F.array(every),
            lambda e: F.concat(F.array(e), F.transform(h, lambda x: e.bitwiseXOR(x))),
        )

    return F.flatten(F.flatten(F.transform(F.array(rest), keys)))


def line_keys(hashes: Column, n: Column, at: Column) -> Column:
    """Keys of which lines that are alike share one; a line of one to three words has none."""
    none = F.array().cast("array<bigint>")
    return F.concat(
        F.when(n >= LEAST_BLOCKED, block_keys(hashes, n, at)).otherwise(none),
        F.when((n >= STRETCH - 1) & (n <= MOST_RESTED), rest_keys(hashes)).otherwise(none),
    )


def parities(hashes: Column) -> list[Column]:
    """128 parities of a line as two numbers, ``lo`` and ``hi``; each word turns one of them."""

    def turned(some: Column) -> Column:
        return F.aggregate(
            some,
            F.lit(0).cast("long"),
            lambda bits, x: bits.bitwiseXOR(
                F.call_function(
                    "shiftleft", F.lit(1).cast("long"), x.bitwiseAND(F.lit(63)).cast("int")
                )
            ),
        )

    return [
        turned(F.filter(hashes, lambda x: x >= 0)).alias("lo"),
        turned(F.filter(hashes, lambda x: x < 0)).alias("hi"),
    ]


def near(a: str, b: str) -> Column:
    """Whether lengths and parities do not rule out that two lines are alike.

    A word that is replaced turns two parities at most, one that is put in or left
    out turns one, and there are at least as many of these as the lengths differ.
    """
    most = edits(F.greatest(f"{a}n", f"{b}n"))
    apart = F.abs(F.col(f"{a}n") - F.col(f"{b}n"))
    turned = [F.bit_count(F.col(f"{a}{c}").bitwiseXOR(F.col(f"{b}{c}"))) for c in ("lo", "hi")]
    return (apart <= most) & (turned[0] + turned[1] <= 2 * most - apart)


def distinct_buckets(mixed: DataFrame) -> DataFrame:
    """The rows (key, id, ...) of ``mixed`` without buckets whose ids are those of another one.

    Adds how many ``ids`` the bucket has.
    """
    sets = mixed.groupBy("key").agg(
        F.count(F.lit(1)).alias("ids"),
        F.bit_xor(F.xxhash64("id")).alias("x"),
        F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"),
    )
    first = sets.groupBy("ids", "x", "y").agg(F.min("key").alias("key"))
    return mixed.join(store(first.select("key", "ids"), "distinct-buckets"), "key")


def near_pairs(mixed: DataFrame) -> DataFrame:
    """Pairs (a, b) of one key and different components that :func:`near` lets pass.

    Lengths are put into bands in which each is 1.12 times the one before, five
    added. Lines that are alike are in one band or in two that follow each other,
    so a bucket is joined band by band, and no pair is a row before it has passed.
    A pair is made in the least key that both lines have; those of more than
    KEYS_HELD keys are made in each. Where ``mixed`` has ``line``, the lines as
    characters, a pair passes if they are alike. Where it has ``ids``, the size of
    the bucket, those of large ones are compared by several tasks.
    """
    band = F.floor(F.log(F.col("n") + WORDS_PER_EDIT // 2) / F.log(F.lit(1.12))).cast("int")
    own = F.collect_set("key").over(W.partitionBy("id"))
    held = F.when(F.size("keys") <= KEYS_HELD, F.col("keys")).otherwise(F.array().cast("array<bigint>"))
    chunks = F.ceil(F.col("ids") / CHUNK).cast("int") if "ids" in mixed.columns else F.lit(1)
    rows = store(
        mixed.withColumn("key", F.col("key").cast("long"))
        .withColumns({"band": band, "keys": own, "chunks": chunks})
        .withColumn("keys", held),
        "mixed-lines",
        codec="zstd",
    )
    shorter = rows.withColumn("band", F.explode(F.array("band", F.col("band") + 1))).withColumn(
        "chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
    )
    rows = rows.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    left = shorter.select(*[F.col(c).alias(f"a_{c}") for c in rows.columns])
    right = rows.select(*[F.col(c).alias(f"b_{c}") for c in rows.columns])
    once = F.expr("a_n < b_n OR (a_n = b_n AND a_id < b_id)")
    here = F.expr(
        "size(a_keys) = 0 OR size(b_keys) = 0 OR array_min(array_intersect(a_keys, b_keys)) = a_key"
    )
    passed = once & near("a_", "b_") & here
    if "line" in mixed.columns:
        passed = passed & close(F.col("a_line"), F.col("b_line"))
    return left.join(
        right,
        F.expr("a_key = b_key AND a_band = b_band AND a_chunk = b_chunk AND a_component <> b_component")
        & passed,
    ).select(F.greatest("a_id", "b_id").alias("a"), F.least("a_id", "b_id").alias("b"))


def characters(hashes: Column) -> Column:
    """A line, given as hashes of its words, with each word as one of 20,000 characters."""
    codes = F.transform(hashes, lambda x: F.hex(F.pmod(x, F.lit(20_000)) + 0x4E00))
    return F.decode(F.unhex(F.array_join(codes, "")), "UTF-16BE")


def word_hashes(line: Column) -> Column:
    return F.transform(F.split(line, " "), lambda w: F.xxhash64(w))


def close(x: Column, y: Column) -> Column:
    """:func:`alike` of lines that are characters already."""
    most = edits(F.greatest(F.length(x), F.length(y)))
    within = F.abs(F.length(x) - F.length(y)) <= most
    return F.when(within, F.call_function("levenshtein", x, y, most) >= 0).otherwise(False)


def alike(a: Column, b: Column) -> Column:
    """Whether normalised lines differ by at most as many words as the longer one allows."""
    return close(characters(word_hashes(a)), characters(word_hashes(b)))


PLACE = ("doc_id", "text_hash", "line_no")


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        content.alias("text"),
        F.xxhash64(content).alias("text_hash"),
    )


def repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Lines to leave out: ``doc_id``, ``text_hash`` and ``line_no`` from 0.

    Of each group of lines that are alike all but the first stay out; first is
    the least id, NULL before all, then the least hash of the text and line
    number. A line without words is in no group. Rows equal in id and text
    count as one document. Lines are told apart by 64 bits: among a hundred
    billion different ones a few hundred are expected to be confused.
    """
    rows = _rows(docs, doc_id, text)
    cut = rows.select(
        "doc_id", "text_hash", F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    ).where(F.length("line") > 0)
    occurrences = store(
        cut.select(*PLACE, normalised(F.col("line")).alias("line"))
        .withColumn("hashes", word_hashes(F.col("line")))
        .withColumn("least", least_word(F.col("hashes")))
        .select(
            *PLACE,
            F.monotonically_increasing_id().alias("at"),
            F.xxhash64(F.lit("line"), "line").alias("node"),
            line_keys(F.col("hashes"), F.size("hashes"), F.col("least")).alias("keys"),
            "line",
        ),
        "lines",
        codec="zstd",  # the largest table that is stored
    ).where("line <> ''")
    nodes = store(
        occurrences.groupBy(F.col("node").alias("id")).agg(
            F.min("at").alias("at"), F.count(F.lit(1)).alias("rows")
        ),
        "line-nodes",
    )
    members = shared_buckets(
        occurrences.select(F.explode("keys").alias("key"), F.col("node").alias("id"))
    )
    # What is compared of lines that share a bucket: once for each, however many pairs it is in.
    sharing = store(members.select("id").union(members.select("leader")).distinct(), "sharing")
    place = F.xxhash64("at").alias("place")
    known, _ = parted(nodes.select("id", "at", place), "id", sharing, "id")
    wanted = store(known.join(sharing, "id", "left_semi"), "wanted")
    asked, _ = parted(occurrences.select("at", "line", place), "place", wanted, "place")
    forms = store(
        asked.drop("place")
        .join(wanted.select("id", "at"), "at")
        .select("id", word_hashes(F.col("line")).alias("hashes"))
        .select(
            "id",
            F.size("hashes").alias("n"),
            *parities(F.col("hashes")),
            characters(F.col("hashes")).alias("line"),
        ),
        "line-forms",
        codec="zstd",
    )

    def links_of(mixed: DataFrame) -> DataFrame:
        rows = distinct_buckets(mixed).join(forms, "id")
        return store(near_pairs(rows).distinct(), "links")

    def verify(pairs: DataFrame) -> DataFrame:
        x, y = (
            forms.select(*[F.col(c).alias(f"{p}{c}") for c in forms.columns]) for p in ("a_", "b_")
        )
        return (
            pairs.join(x, F.col("a") == F.col("a_id"))
            .join(y, F.col("b") == F.col("b_id"))
            .where(near("a_", "b_") & close(F.col("a_line"), F.col("b_line")))
            .select("a", "b")
        )

    groups = components(bucket_links(members, verify, links_of))
    linked, alone = parted(nodes, "id", groups, "id")
    joined = (
        linked.union(alone.where("rows > 1"))
        .join(groups, "id", "left")
        .where("rows > 1 OR component IS NOT NULL")
    )
    # Stored, so that a line very many documents hold can be split in the joins.
    several = store(
        joined.select(F.col("id").alias("node"), F.coalesce("component", "id").alias("group")),
        "line-groups",
    )
    likely, _ = parted(occurrences.select(*PLACE, "node"), "node", several, "node")
    placed = store(likely.join(several, "node").select("group", *PLACE), "grouped-lines")
    firsts = store(
        placed.groupBy("group").agg(F.min(F.struct(*PLACE)).alias("kept")), "first-lines"
    )
    return placed.join(firsts, "group").where(
        ~F.struct(*PLACE).eqNullSafe(F.col("kept"))
    ).select(*PLACE)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with repeated lines taken out of the text, ``n_lines`` and ``dropped_lines``.

    The other lines stay as they are, joined as before; a NULL text stays NULL
    and has no lines, an empty one has one. No rows give no rows. Columns of
    ``docs`` that have one of the two names give way to it.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("n_lines", "dropped_lines")])
    held, hashed, cut = spare(docs, "dropped", "text_hash", "lines")
    dropped = store(
        repeated_lines(docs, doc_id, text)
        .groupBy(F.col("doc_id").alias("dropped_id"), F.col("text_hash").alias("dropped_hash"))
        .agg(F.collect_set("line_no").alias(held)),
        "dropped-lines",
    )
    rows = docs.withColumn(hashed, F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))))
    touched, whole = parted(rows, hashed, dropped, "dropped_hash")
    joined = touched.join(
        dropped,
        (F.col(hashed) == F.col("dropped_hash")) & F.col(f"`{doc_id}`").eqNullSafe(F.col("dropped_id")),
        "left",
    )
    # The lines are a column of their own, so that each text is cut once.
    lines = F.col(cut)
    kept = F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(held)), lambda k: F.get(lines, k)
    )
    cut_down = F.when(F.col(held).isNotNull(), F.array_join(kept, "\n")).otherwise(F.col(f"`{text}`"))
    changed = joined.withColumn(cut, F.split(f"`{text}`", "\n")).select(
        *[cut_down.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns],
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size(held), F.lit(0)).cast("long").alias("dropped_lines"),
    )
    plain = F.col(f"`{text}`")
    n_lines = F.length(plain) - F.length(F.replace(plain, F.lit("\n"), F.lit(""))) + 1
    return changed.union(
        whole.select(
            *[f"`{c}`" for c in docs.columns],
            F.coalesce(n_lines, F.lit(0)).cast("long").alias("n_lines"),
            F.lit(0).cast("long").alias("dropped_lines"),
        )
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without repeated lines, for a corpus.

    A document of which no word is left is a copy and goes; one without words
    from the start stays. ``n_chars``, where there is one, follows the text.
    """
    held = {c: n for c, n in zip(docs.columns, spare(docs, *docs.columns)) if c.lower() in ("n_lines", "dropped_lines")}
    found = without_repeats(docs.withColumnsRenamed(held))
    left = found.where((F.col("dropped_lines") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        changed = F.when(F.col("dropped_lines") > 0, F.length("text").cast(kind))
        left = left.withColumn("n_chars", changed.otherwise(F.col("n_chars")))
    return left.select(*[F.col(f"`{held.get(c, c)}`").alias(c) for c in docs.columns])
