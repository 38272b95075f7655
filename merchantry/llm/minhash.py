"""Near-duplicate documents: MinHash bands, sequential Bayesian pruning, exact check.

Documents are sets of word shingles. Equal sets are one class from the start,
however many documents have them. Classes sharing a band of their MinHash
signature are candidates. Their signatures are compared batch by batch, and a
pair is dropped as soon as the probability that it is similar enough, given
the matches so far, falls below the chosen miss probability. What survives is
compared on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import store
from .clusters import bucket_links, components, parted
from .common import spare

WORDS = 5
PERCENT = 75

# A pair of similarity 0.75 shares no band with probability 1e-4, one of 0.8 with 3e-7.
BANDS, BAND_ROWS = 64, 7

# Hashes of the signature that are compared, in batches, and the miss probability.
COMPARED, BATCH = 256, 32
MISS = 1e-6

# Members of a bucket that one task compares with as many others, and hashes it compares.
CHUNK = 1024
CHUNK_HASHES = 128

# Shingles of a set that goes there whole, so that only pairs that are similar enough come back.
SET_HELD = 4096

CACHED_WORDS = 500_000

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    steps = np.arange(1, 2 * count + 1, dtype=np.uint64) * _MULTIPLIER
    numbers = _mixed(steps)
    return numbers[:count] | np.uint64(1), numbers[count:]


class _Words(dict):
    """Hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingles(text: str | None, known: _Words, size: int = WORDS) -> np.ndarray:
    """Ascending distinct 64-bit hashes of a text's word shingles, A-Z lower-cased.

    Bytes are lower-cased and split as ASCII, so other letters and other kinds
    of space are left as they are. A text of fewer words is one shingle.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    size_now = min(size, len(words))
    count = len(words) - size_now + 1
    total = np.full(count, size_now, np.uint64)
    for k in range(size_now):
        total = _mixed(total * _MULTIPLIER + hashes[k : k + count])
    return np.unique(total)


def signature(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least 32-bit hash of a non-empty set under each permutation."""
    least = np.full(len(a), 0xFFFFFFFF, np.uint64)
    for start in range(0, len(values), 2048):
        part = values[start : start + 2048]
        hashed = np.multiply.outer(a, part)
        hashed += b[:, None]
        np.minimum(least, hashed.min(axis=1) >> np.uint64(32), out=least)
    return least.astype(np.uint32)


def _signatures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (key, text) to their set's size, class, compared hashes and bands."""
    a, b = _permutations(BANDS * BAND_ROWS)
    seeds = _mixed(np.arange(1, BANDS + 1, dtype=np.uint64))
    known = _Words()
    with np.errstate(over="ignore"):
        for batch in batches:
            out = []
            for text in batch["text"]:
                found = shingles(text, known)
                if not len(found):
                    out.append((0, None, None, None))
                    continue
                hashes = signature(found, a, b)
                bands = seeds.copy()
                for column in hashes.reshape(BANDS, BAND_ROWS).T:
                    bands = _mixed(bands * _MULTIPLIER + column)
                label = (found ^ (found >> np.uint64(29))).sum(dtype=np.uint64) + np.uint64(len(found))
                out.append(
                    (
                        len(found),
                        int(_mixed(np.array([label]))[0].astype(np.int64)),
                        hashes[:COMPARED].astype(np.uint16).tobytes(),
                        bands.view(np.int64),
                    )
                )
            frame = pd.DataFrame(out, columns=["n_shingles", "class", "hashes", "bands"])
            frame["class"] = frame["class"].astype("Int64")
            for column in ("doc_id", "text_hash"):
                frame.insert(0, column, batch[column].to_numpy())
            yield frame


def least_matches(compared: int, percent: int = PERCENT, miss: float = MISS) -> int:
    """Matches of ``compared`` hashes below which a pair is similar with less than ``miss``.

    With an even prior the similarity given m of n matches follows
    Beta(m + 1, n - m + 1), whose upper tail is a sum of binomial terms.
    """
    t, n = percent / 100, compared + 1
    tail = 0.0
    for m in range(compared + 1):
        tail += comb(n, m) * t**m * (1 - t) ** (n - m)
        if tail >= miss:
            return m
    return compared


def _prune(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs with the hashes of both sides to those that survive all batches."""
    bounds = [(n, least_matches(n)) for n in range(BATCH, COMPARED + 1, BATCH)]
    for batch in batches:
        alive = np.arange(len(batch))
        left, right = (
            np.frombuffer(b"".join(batch[c]), np.uint16).reshape(-1, COMPARED)
            for c in ("hashes_a", "hashes_b")
        )
        matches = np.zeros(len(batch), int)
        for n, least in bounds:
            here = slice(n - BATCH, n)
            matches[alive] += (left[alive, here] == right[alive, here]).sum(axis=1)
            alive = alive[matches[alive] >= least]
        yield batch.iloc[alive][["a", "b"]]


def _chunk_pairs(frame: pd.DataFrame) -> pd.DataFrame:
    """Pairs of different components in the buckets of a frame that may be similar enough.

    A frame holds whole small buckets, or two chunks of a large one, of which
    only pairs between the two are compared (one chunk: inside it). Pairs that
    survive the first batches are compared on the halved hashes of their sets, which
    can find too much in common, never too little; a set that is not there passes.
    """
    bounds = [(n, least_matches(n)) for n in range(BATCH, CHUNK_HASHES + 1, BATCH)]
    frame = frame.sort_values(["key", "chunk"], kind="stable")
    hashes = np.frombuffer(b"".join(frame["hashes"]), np.uint16).reshape(-1, CHUNK_HASHES)
    ids, groups, chunks = (frame[c].to_numpy() for c in ("id", "component", "chunk"))
    first, second = frame["first"].to_numpy(), frame["second"].to_numpy()
    cuts = np.flatnonzero(np.diff(frame["key"].to_numpy())) + 1
    # Hashes of sets as numbers from 0, so that those of a set are marked in an array.
    held = [np.frombuffer(x or b"", np.uint32) for x in frame["members"]]
    lengths = np.array([len(x) for x in held])
    distinct, numbers = np.unique(np.concatenate(held), return_inverse=True)
    sets = np.split(numbers, np.cumsum(lengths)[:-1])
    mine = np.zeros(len(distinct), bool)
    a, b = [], []
    for rows in np.split(np.arange(len(frame)), cuts):
        cross = len(rows) and first[rows[0]] != second[rows[0]]
        for k, row in enumerate(rows):
            if cross and chunks[row] != first[row]:
                break
            others = rows[chunks[rows] == second[row]] if cross else rows[k + 1 :]
            others = others[groups[others] != groups[row]]
            matches = np.zeros(len(others), int)
            for n, least in bounds:
                if not len(others):
                    break
                here = slice(n - BATCH, n)
                matches += (hashes[others, here] == hashes[row, here]).sum(axis=1)
                near = matches >= least
                others, matches = others[near], matches[near]
            compared = others[lengths[others] > 0]
            if lengths[row] and len(compared):
                mine[sets[row]] = True
                found = mine[np.concatenate([sets[x] for x in compared])]
                mine[sets[row]] = False
                common = np.add.reduceat(found, np.r_[0, np.cumsum(lengths[compared])[:-1]], dtype=np.int64)
                union = lengths[row] + lengths[compared] - common
                unlike = compared[100 * common < PERCENT * union]
                others = others[~np.isin(others, unlike)]
            a.extend(np.maximum(ids[others], ids[row]))
            b.extend(np.minimum(ids[others], ids[row]))
    return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})


def _held_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (id, text) to the halves of the hashes of their sets; none of a very large one."""
    known = _Words()
    with np.errstate(over="ignore"):
        for batch in batches:
            sets = [shingles(text, known) for text in batch["text"]]
            halves = [(x >> np.uint64(32)).astype(np.uint32).tobytes() if len(x) <= SET_HELD else None for x in sets]
            yield pd.DataFrame({"id": batch["id"], "members": pd.Series(halves, index=batch.index, dtype=object)})


def _exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs with both texts to those whose full sets are similar enough."""
    known = _Words()
    with np.errstate(over="ignore"):
        for batch in batches:
            keep, sets = [], {}
            for text_a, text_b in zip(batch["text_a"], batch["text_b"]):
                if text_b not in sets:
                    sets = {text_b: shingles(text_b, known)}
                x, y = shingles(text_a, known), sets[text_b]
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= PERCENT * (len(x) + len(y) - common) and common > 0)
            yield batch.loc[keep, ["a", "b"]]


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_group: bool = False
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``.

    Documents whose sets of 5-word shingles have a similarity of 0.75 or more
    are linked; ``component_id`` is the least id reachable. A text without
    words, or NULL, has an empty set and is linked with nothing. A row without
    id takes part, but gives its group no id; alone, it has no component and is
    not kept. Rows of one id and equal sets are in one group, so all or none
    are kept. Other columns are ignored; no rows give no rows. ``with_group``
    adds ``text_hash`` and ``group``, a number of the group whatever ids it has.

    Classes of equal sets are told apart by 64 bits: among ten billion sets
    three pairs are expected to be confused.
    """
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.xxhash64(content).alias("text_hash"),
        content.alias("text"),
    )
    signed = store(
        rows.mapInPandas(
            _signatures,
            "text_hash bigint, doc_id bigint, n_shingles bigint, class bigint, hashes binary,"
            " bands array<bigint>",
        ),
        "signatures",
    )
    # A class, its least id, and the row that stands for it.
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    classes = store(
        signed.where(F.col("class").isNotNull())
        .groupBy("class")
        .agg(F.min("doc_id").alias("least"), F.min(order).alias("row"))
        .select("class", "least", "row.doc_id", "row.text_hash"),
        "classes",
    )

    # One row per class, with its compared hashes.
    stands = classes.select(F.col("class").alias("of"), "doc_id", "text_hash")
    sides = signed.join(
        stands,
        (signed["class"] == stands["of"])
        & signed["doc_id"].eqNullSafe(stands["doc_id"])
        & (signed["text_hash"] == stands["text_hash"]),
        "left_semi",
    ).select("class", "hashes").dropDuplicates(["class"])

    def verify(pairs: DataFrame) -> DataFrame:
        first = sides.select(F.col("class").alias("a"), F.col("hashes").alias("hashes_a"))
        second = sides.select(F.col("class").alias("b"), F.col("hashes").alias("hashes_b"))
        likely = store(
            pairs.join(first, "a").join(second, "b").mapInPandas(_prune, "a bigint, b bigint"),
            "likely",
        )
        # Which text is needed for which pair: of the first class under the second, and of the second.
        wanted = store(
            likely.union(likely.select(F.col("b").alias("a"), "b").distinct())
            .join(stands, F.col("a") == F.col("of"))
            .select("a", "b", F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")),
            "wanted",
        )
        asked, _ = parted(rows, "text_hash", wanted, "hash")
        found = store(
            asked.join(
                wanted, (F.col("text_hash") == F.col("hash")) & F.col("doc_id").eqNullSafe(F.col("id"))
            ).select("a", "b", "text"),
            "wanted-texts",
        )
        members = found.where("a <> b").withColumnRenamed("text", "text_a")
        leaders = found.where("a = b").select("b", F.col("text").alias("text_b"))
        return members.join(leaders, "b").mapInPandas(_exact, "a bigint, b bigint").distinct()

    def links_of(mixed: DataFrame) -> DataFrame:
        # Pairs are compared where they are made, and only survivors are rows. A large
        # bucket is cut into chunks, and each pair of chunks is a group by itself.
        asking = store(
            mixed.select("id").distinct().join(stands, F.col("id") == F.col("of")).select(
                "id", F.col("doc_id").alias("at"), F.col("text_hash").alias("hash")
            ),
            "wanted",
        )
        asked, _ = parted(rows, "text_hash", asking, "hash")
        here = (F.col("text_hash") == F.col("hash")) & F.col("doc_id").eqNullSafe(F.col("at"))
        sets = (
            asked.join(asking, here)
            .select("id", "text")
            .mapInPandas(_held_sets, "id bigint, members binary")
        )
        hashes = store(
            sides.select(
                F.col("class").alias("id"), F.substring("hashes", 1, 2 * CHUNK_HASHES).alias("hashes")
            ).join(sets.dropDuplicates(["id"]), "id"),
            "held-sets",
        )
        sizes = mixed.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        chunks = F.ceil(F.col("n") / CHUNK).cast("int")
        other = F.explode(F.sequence(F.lit(0), chunks - 1))
        placed = (
            mixed.join(store(sizes, "bucket-sizes"), "key")
            .withColumn("chunk", F.pmod(F.xxhash64("id"), chunks).cast("int"))
            .withColumn("other", other)
            .withColumn("first", F.least("chunk", "other"))
            .withColumn("second", F.greatest("chunk", "other"))
            # Small buckets share groups of a few thousand rows.
            .withColumn("part", F.when(F.col("n") > CHUNK, F.xxhash64("key", "first", "second")))
        )
        few = max(1, mixed.count() // CHUNK)
        small = F.pmod(F.xxhash64("key"), F.lit(few))
        pairs = (
            placed.join(hashes, "id")
            .select(
                "key", "id", "component", "chunk", "first", "second", "hashes", "members",
                F.coalesce("part", small).alias("part"),
            )
            .groupBy("part", F.col("first").alias("_f"), F.col("second").alias("_s"))
            .applyInPandas(_chunk_pairs, "a bigint, b bigint")
        )
        return verify(store(pairs.distinct(), "pairs"))

    bands = signed.where(F.col("class").isNotNull()).select(
        F.explode("bands").alias("key"), F.col("class").alias("id")
    )
    groups = components(bucket_links(bands, verify, links_of)).withColumnRenamed("id", "class")
    named = classes.select("class", "least").join(groups, "class", "left").select(
        "class", "least", F.coalesce("component", "class").alias("component")
    )
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    labels = store(
        named.join(least, "component").select("class", "component_id", "component"), "labels"
    )
    extra = ["text_hash", F.col("component").alias("group")] if with_group else []
    return (
        signed.select("doc_id", "n_shingles", "class", "text_hash")
        .join(labels, "class", "left")
        .select(
            "doc_id",
            "n_shingles",
            *extra,
            F.when(F.col("class").isNull(), F.col("doc_id"))
            .otherwise(F.col("component_id"))
            .alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group the least ``doc_id`` stays.

    A row is known by its id and text: a row of the same id and another text has
    a group of its own. Of rows equal in both one stays. In a group without ids
    the row of the least text hash stays; a text without words is like no other
    and stays.
    """
    found = near_duplicates(docs, with_group=True).where("n_shingles > 0")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    firsts = found.groupBy("group").agg(F.min(order).alias("first")).select(
        "group", "first.doc_id", "first.text_hash"
    )
    kept_id, kept_hash, hashed = spare(docs, "kept_id", "kept_hash", "text_hash")
    (number,) = spare(docs, "number")
    stays = store(
        firsts.select(F.col("doc_id").alias(kept_id), F.col("text_hash").alias(kept_hash)), "kept"
    )
    rows = docs.withColumn(hashed, F.xxhash64(F.coalesce("text", F.lit(""))))
    wordless = ~F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    same = (F.col(hashed) == F.col(kept_hash)) & F.col("doc_id").cast("long").eqNullSafe(F.col(kept_id))
    # Rows equal in id and text are numbered; there are none of them where ids are unique.
    twice = (
        rows.where(~wordless)
        .groupBy(F.col("doc_id").alias(kept_id), F.col(hashed).alias(kept_hash))
        .agg(F.count(F.lit(1)).alias(number))
        .where(F.col(number) > 1)
    )
    own = [f"`{c}`" for c in docs.columns]
    left = rows.where(~wordless).join(stays, same, "left_semi")
    several = store(twice, "repeated-rows")
    if not several.isEmpty():
        again = (F.col(hashed) == F.col(kept_hash)) & F.col("doc_id").eqNullSafe(F.col(kept_id))
        copies = left.join(several, again, "left_semi").dropDuplicates(["doc_id", hashed])
        left = left.join(several, again, "left_anti").unionByName(copies)
    return left.select(*own).union(rows.where(wordless).select(*own))
