"""Document fingerprints from closed syncmers.

A text is read as tokens. Of every K consecutive tokens the hashes of its inner
runs of S tokens are compared, and the K tokens are an anchor if the least of
them is the first or the last. Whether they are depends on these K tokens
alone, so a passage has the same anchors wherever it stands, and an edit
changes only the anchors it touches. A fingerprint is the least hashes of all
anchors; two fingerprints estimate how alike the sets of anchors are.

Everything is built-in functions on the row; only texts whose neighbour is
needed are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..operators.ordering import surrogate_key
from ..session import store

K, S = 5, 2

# Least hashes kept: the estimate of a likeness of one half is off by 0.06 on average.
KEPT = 64

# Runs of characters of scripts with spaces; any other character is a token by itself.
TOKEN = r"[\x21-\x7E\xA0-෿]+|[^\x20\x09-\x0D]"


def _with_runs(df: DataFrame, text: str, prefix: str) -> DataFrame:
    """Adds hashes of tokens, and of each run of S tokens, in columns named by ``prefix``."""
    tokens, runs = f"{prefix}_tokens", f"{prefix}_runs"
    df = df.withColumn(
        tokens,
        F.transform(
            F.regexp_extract_all(F.col(text), F.lit(TOKEN), F.lit(0)), lambda t: F.xxhash64(t)
        ),
    )
    t = F.col(tokens)
    return df.withColumn(
        runs,
        F.transform(
            F.slice(t, F.lit(1), F.greatest(F.size(t) - (S - 1), F.lit(0))),
            lambda h, i: F.xxhash64(h, *[F.get(t, i + j) for j in range(1, S)]),
        ),
    )


def _at_anchors(prefix: str, made) -> Column:
    """``made(hash, place)`` for each anchor; a text that has none is one anchor as a whole."""
    t, r = F.col(f"{prefix}_tokens"), F.col(f"{prefix}_runs")
    last = K - S  # of the runs inside K tokens, counted from 0

    def of(first: Column, i: Column) -> Column:
        inner = F.least(*[F.get(r, i + j) for j in range(1, last)])
        covered = [F.get(r, i + j) for j in [*range(S, last, S), last]]
        return F.when(
            F.least(first, F.get(r, i + last)) <= inner, made(F.xxhash64(first, *covered), i)
        )

    found = F.array_compact(
        F.transform(F.slice(r, F.lit(1), F.greatest(F.size(r) - last, F.lit(0))), of)
    )
    whole = made(F.xxhash64(t), F.lit(0))

    def with_whole(anchors: Column) -> Column:
        return F.when((F.size(anchors) == 0) & (F.size(t) > 0), F.array(whole)).otherwise(anchors)

    # Inside one array, so that the anchors are found once.
    return F.flatten(F.transform(F.array(found), with_whole))


def anchors(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per anchor of every document: ``doc_id``, ``place`` in tokens, ``hash``.

    For positional matching: equal hashes at places that differ by a constant
    are a shared passage. A text without tokens, or NULL, has none.
    """
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    found = _at_anchors("f", lambda h, i: F.struct(i.alias("place"), h.alias("hash")))
    return (
        _with_runs(rows, "text", "f")
        .select("doc_id", F.explode(found).alias("a"))
        .select("doc_id", "a.place", "a.hash")
    )


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the fingerprint of a text column without NULLs: ascending 31-bit hashes."""
    prefix = f"_{name}"
    found = _at_anchors(prefix, lambda h, i: h.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int"))
    least = F.slice(F.sort_array(F.array_distinct(found)), 1, KEPT)
    return _with_runs(df, text, prefix).select(*df.columns, least.alias(name))


def fingerprint_text(fingerprint: Column) -> Column:
    """A fingerprint as hexadecimal digits, eight per hash."""
    return F.lower(
        F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x), 8, "0")), "")
    )


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of anchors two texts have in common, 0 to 1; 1 if neither has any.

    The least hashes of both together are a fair sample of all anchors; those
    in both fingerprints are the common ones.
    """
    both = F.slice(F.sort_array(F.array_union(a, b)), 1, KEPT)
    common = F.array_intersect(both, F.array_intersect(a, b))
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(F.size(common) / F.size(both))


def fingerprint_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's fingerprint beside that of an edited text and of the next document.

    The next document is that with the next smaller ``doc_id``, NULL last, and
    after the last the first. The edited text has the last ``floor(n / 2)`` of
    ``n`` characters replaced by the first as many of the next document. A NULL
    text is empty. Rows with equal id and text are one place in the order and
    give a row each; rows of one id with different texts follow each other in
    the order of a hash. Other columns are ignored. No rows give no rows.
    """
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        content.alias("text"),
        F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(-(2**63))).alias("key_id"),
        F.xxhash64(F.col(f"`{doc_id}`"), content).alias("key_hash"),
    )
    key = ["key_id", "key_hash"]
    known = store(
        with_fingerprint(rows, "text", "fingerprint").select(
            "doc_id", *key, F.length("text").cast("long").alias("n_chars"), "fingerprint"
        ),
        "fingerprints",
    ).dropDuplicates(key)
    places = known.select(
        F.col("doc_id").isNull().alias("none"), F.bitwise_not("key_id").alias("down"), "key_hash", "n_chars"
    )
    numbered = surrogate_key(places, ["none", "down", "key_hash"], "number")
    total = numbered.count()
    # For the next document of each: who comes before, and how much that one takes.
    after = numbered.select(
        (F.col("number") % F.lit(max(total, 1)) + 1).alias("number"),
        F.bitwise_not("down").alias("to_id"),
        F.col("key_hash").alias("to_hash"),
        F.floor(F.col("n_chars") / 2).cast("int").alias("taken"),
    )
    links = numbered.select("number", F.bitwise_not("down").alias("key_id"), "key_hash").join(
        after, "number"
    )
    # Texts travel with their key alone, so both uses below read one shuffle.
    whole = rows.select(*key, "text").join(known.join(links.drop("number"), key), key)
    once = F.row_number().over(W.partitionBy(*key).orderBy(*key))
    heads = (
        whole.withColumn("once", once)
        .where(F.col("once") == 1)
        .select(
            F.col("to_id").alias("key_id"),
            F.col("to_hash").alias("key_hash"),
            F.substring("text", F.lit(1), F.col("taken")).alias("head"),
            F.col("fingerprint").alias("next_fingerprint"),
        )
    )
    kept = (F.col("n_chars") - F.floor(F.col("n_chars") / 2)).cast("int")
    edited = whole.join(heads, key).select(
        "doc_id",
        "n_chars",
        "fingerprint",
        "next_fingerprint",
        F.concat(F.substring("text", F.lit(1), kept), F.col("head")).alias("edited"),
    )
    return with_fingerprint(edited, "edited", "edited_fingerprint").select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
