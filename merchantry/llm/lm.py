"""Language-model scores by deleted interpolation.

The probability of a word after another is a mix of the share of the pair
among the pairs of the first word, the share of the word among all, and an
even share. How much each counts depends on how often the first word was seen:
contexts are put into buckets by that, and the weights of each bucket are
learned by expectation-maximisation on counts of texts that are left out when
the shares are taken. Counts of the final model are those of all training
texts.

Counts are gathered in one shuffle. Texts are read in blocks; a block sends
each distinct word and pair once, as arrays of hashes by hash part, so a word
that is everywhere is one entry per block. A part sums them and answers every
block with the totals in the order it asked, and a block then scores its texts
with the answers beside it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import store

# Training texts: those whose CRC-32 of the id leaves another remainder than HELD_OUT; the
# weights are learned on the texts that leave DELETED.
FOLDS, HELD_OUT, DELETED = 7, 2, 6

BLOCK_BYTES = 8 << 20
PART_BYTES = 4 << 20
UNIGRAM_SHARE = 8  # parts of pairs for one part of words
ROUNDS = 12
START_WEIGHTS = (0.4, 0.4, 0.2)  # of pair, word and even share
LEAST_EVEN = 1e-6  # so that an unknown word has a probability in every bucket
BUCKETS = 64
CACHED_WORDS = 200_000

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
START, END = np.uint64(1), np.uint64(2)  # no hash of a word, as their chance is nil


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def token_hashes(texts: list[str], known: _Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all tokens, of the token before each, and the number of tokens per text.

    Words are split at ASCII white space, A-Z lower-cased; an end token follows.
    """
    parts, counts = [], np.empty(len(texts), np.int64)
    for k, text in enumerate(texts):
        words = text.encode("utf-8", "replace").lower().split()
        counts[k] = len(words) + 1
        parts.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
        parts.append(np.array([END]))
    flat = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    before = np.empty_like(flat)
    before[1:] = flat[:-1]
    before[np.cumsum(counts) - counts] = START
    return flat, before, counts


def packed(counts: np.ndarray) -> bytes:
    """Counts as one byte each; those of 255 and more follow as eight bytes."""
    small = np.minimum(counts, 255).astype(np.uint8)
    return small.tobytes() + counts[small == 255].astype(np.int64).tobytes()


def unpacked(data: bytes, count: int) -> np.ndarray:
    counts = np.frombuffer(data, np.uint8, count).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, np.int64, offset=count)
    return counts


class Block:
    """Distinct words and pairs of some texts, in the order they are asked for."""

    def __init__(self, texts: list[str], parts: int, known: _Words):
        with np.errstate(over="ignore"):
            flat, before, self.counts = token_hashes(texts, known)
            pairs = _mixed(before * _MULTIPLIER + flat)
        words = max(1, parts // UNIGRAM_SHARE)
        self.asked = []  # keys, index of each token's key, number of the first part, parts
        for keys, first, of in ((pairs, 0, parts), (flat, parts, words)):
            distinct, index = np.unique(keys, return_inverse=True)
            part = ((distinct >> np.uint64(33)) % np.uint64(of)).astype(np.int64) + first
            order = np.argsort(part, kind="stable")
            place = np.empty_like(order)
            place[order] = np.arange(len(order))
            self.asked.append((distinct[order], place[index], part[order]))
        self.before = before

    def rows(self, block: int, masks: list[np.ndarray]) -> Iterator[dict]:
        """What goes to each part: keys, and how often each is in the texts of each mask."""
        for keys, index, part in self.asked:
            sums = [np.bincount(index[m], minlength=len(keys)) for m in masks]
            cuts = np.flatnonzero(np.diff(part, prepend=-1, append=-1)) if len(part) else []
            for a, b in zip(cuts[:-1], cuts[1:]):
                yield {
                    "part": int(part[a]),
                    "block": block,
                    "keys": keys[a:b].view(np.int64),
                    "counts": packed(sums[0][a:b]),
                    "kept_counts": packed(sums[1][a:b]),
                }

    def answers(self, found: pd.DataFrame, columns: tuple[str, ...]) -> list[list[np.ndarray]]:
        """Totals for each token's pair and word, by column, from the rows of all parts."""
        by_part = {row.part: row for row in found.itertuples()}
        out = []
        for keys, index, part in self.asked:
            cuts = np.flatnonzero(np.diff(part, prepend=-1, append=-1)) if len(part) else []
            totals = [np.empty(len(keys), np.int64) for _ in columns]
            for a, b in zip(cuts[:-1], cuts[1:]):
                row = by_part[int(part[a])]
                if row.check != int(np.bitwise_xor.reduce(keys[a:b].view(np.int64))):
                    raise RuntimeError("the documents changed between two passes")
                for total, column in zip(totals, columns):
                    total[a:b] = unpacked(getattr(row, column), b - a)
            out.append([total[index] for total in totals])
        return out


def _asking(parts: int):
    """Batches of (block, role, text) in order of blocks to what the blocks ask."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Words()

        def flush(block: int, frames: list[pd.DataFrame]) -> pd.DataFrame:
            texts = [t for f in frames for t in f["text"]]
            roles = np.concatenate([f["role"].to_numpy() for f in frames])
            asked = Block(texts, parts, known)
            role = np.repeat(roles, asked.counts)
            return pd.DataFrame(asked.rows(block, [role != HELD_OUT, ~np.isin(role, (HELD_OUT, DELETED))]))

        held, current = [], None
        for batch in batches:
            for block, frame in batch.groupby("block", sort=True):
                if current is not None and block != current:
                    yield flush(current, held)
                    held = []
                current = block
                held.append(frame)
        if held:
            yield flush(current, held)

    return run


def _answering(frame: pd.DataFrame) -> pd.DataFrame:
    """What all blocks ask of one part to the totals, and what the part itself holds."""
    keys = np.concatenate(list(frame["keys"])).view(np.uint64)
    distinct, index = np.unique(keys, return_inverse=True)
    sizes = [len(k) for k in frame["keys"]]
    totals = [
        np.bincount(
            index, np.concatenate([unpacked(d, n) for d, n in zip(frame[c], sizes)]), len(distinct)
        ).astype(np.int64)
        for c in ("counts", "kept_counts")
    ]
    counts, kept = (
        [packed(x) for x in np.split(t[index], np.cumsum(sizes)[:-1])] for t in totals
    )
    checks = [int(np.bitwise_xor.reduce(k)) for k in frame["keys"]]
    part = int(frame["part"].iloc[0])
    answers = pd.DataFrame(
        {"part": part, "block": frame["block"], "check": checks, "counts": counts, "kept_counts": kept}
    )
    for name, value in zip(
        SUMMARY, (totals[0].sum(), (totals[0] > 0).sum(), totals[1].sum())
    ):
        answers[name] = 0
        answers.loc[0, name] = int(value)
    return answers


# Of a part, on one of its rows: tokens and kinds in training, and tokens of the texts kept.
SUMMARY = ("tokens", "kinds", "kept_tokens")
ANSWER = (
    "part int, block bigint, check bigint, counts binary, kept_counts binary,"
    " tokens bigint, kinds bigint, kept_tokens bigint"
)


def bucket_of(counts: np.ndarray) -> np.ndarray:
    """Bucket of a context by its frequency: 0 if never seen, else one per doubling."""
    found = np.zeros(len(counts), np.int64)
    seen = counts > 0
    found[seen] = np.floor(np.log2(counts[seen])).astype(np.int64) + 1
    return found


def _features(block: Block, found: pd.DataFrame, column: str, starts: int) -> tuple[np.ndarray, ...]:
    """Counts of each token's pair, context and word."""
    (pair,), (word,) = block.answers(found, (column,))
    context = np.empty_like(word)
    context[1:] = word[:-1]
    context[block.before == START] = starts
    return pair, context, word


def _deleted_counts(parts: int, starts: int):
    """A block of left-out texts with its answers to how often each case is in them."""

    def run(texts: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        texts = texts.sort_values("place")
        block = Block(list(texts["text"]), parts, _Words())
        pair, context, word = _features(block, found, "kept_counts", starts)
        left_out = np.repeat(texts["role"].to_numpy() == DELETED, block.counts)
        cases = pd.DataFrame({"pair": pair, "context": context, "word": word})[left_out]
        return cases.groupby(["pair", "context", "word"]).size().reset_index(name="n")

    return run


def _scoring(parts: int, total: int, kinds: int, starts: int, weights: np.ndarray):
    """A block of texts with its answers to their scores."""

    def run(texts: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        texts = texts.sort_values("place")
        block = Block(list(texts["text"]), parts, _Words())
        pair, context, word = _features(block, found, "counts", starts)
        mix = weights[bucket_of(context)]
        chance = (
            mix[:, 0] * (pair / np.maximum(context, 1))
            + mix[:, 1] * (word / max(total, 1))
            + mix[:, 2] / (kinds + 1)
        )
        first = np.cumsum(block.counts) - block.counts
        return pd.DataFrame(
            {
                "doc_id": texts["doc_id"].to_numpy(),
                "held_out": texts["role"].to_numpy() == HELD_OUT,
                "n_tokens": block.counts,
                "n_known": np.add.reduceat((word > 0).astype(np.int64), first),
                "train_tokens": total,
                "base_score": np.add.reduceat(np.log10((word + 1) / (total + kinds + 1)), first),
                "score": np.add.reduceat(np.log10(chance), first),
            }
        )

    return run


def learn_weights(
    cases: DataFrame, total: int, kinds: int, rounds: int = ROUNDS
) -> np.ndarray:
    """Weights of pair, word and even share by bucket, from counted cases of left-out texts.

    Each round is one aggregate with a row per bucket. A bucket without cases
    takes the weights of the next smaller one that has some.
    """
    weights = np.tile(START_WEIGHTS, (BUCKETS, 1))
    context = F.col("context")
    shares = store(
        cases.select(
            F.when(context > 0, F.floor(F.log2(context)).cast("int") + 1).otherwise(0).alias("bucket"),
            F.when(context > 0, F.col("pair") / context).otherwise(F.lit(0.0)).alias("p"),
            (F.col("word") / F.lit(max(total, 1))).alias("w"),
            "n",
        ),
        "deleted-cases",
    )
    even = 1.0 / (kinds + 1)
    seen: list[int] = []
    for _ in range(rounds):
        table = [F.array(*[F.lit(float(x)) for x in weights[:, k]]) for k in range(3)]
        a, b, c = (F.element_at(t, F.col("bucket") + 1) for t in table)
        parts = shares.select(
            "bucket", "n", (a * F.col("p")).alias("x"), (b * F.col("w")).alias("y"), (c * even).alias("z")
        )
        whole = F.col("x") + F.col("y") + F.col("z")
        sums = parts.groupBy("bucket").agg(
            *[F.sum(F.col("n") * F.col(k) / whole).alias(k) for k in ("x", "y", "z")]
        )
        seen = []
        for row in sums.collect():
            found = np.array([row["x"], row["y"], row["z"]])
            found = np.maximum(found / found.sum(), [0, 0, LEAST_EVEN])
            weights[row["bucket"]] = found / found.sum()
            seen.append(row["bucket"])
    for bucket in range(BUCKETS):
        if seen and bucket not in seen:
            smaller = [b for b in seen if b < bucket]
            weights[bucket] = weights[max(smaller) if smaller else min(seen)]
    return weights


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: tokens, known tokens, and scores of the base and of the mixed model.

    A NULL or empty text is one end token; a NULL id counts as an empty one
    when texts are dealt to training and held-out ones. Rows that are repeated
    count as often as they are there. Other columns are ignored; no rows give
    no rows, and without training texts every token is unknown.

    Words and pairs are told apart by 64 bits.
    """
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    label = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.pmod(F.crc32(label), F.lit(FOLDS)).cast("int").alias("role"),
        content.alias("text"),
        F.monotonically_increasing_id().alias("place"),
    )
    size = rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.octet_length("text")).alias("bytes"),
        F.count_if(~F.col("role").isin(HELD_OUT)).alias("training"),
        F.count_if(~F.col("role").isin(HELD_OUT, DELETED)).alias("kept"),
    ).first()
    parts = max(8, -(-(size["bytes"] or 0) // PART_BYTES))
    per_block = max(1, size["rows"] * BLOCK_BYTES // max(size["bytes"] or 0, 1))
    # Consecutive rows of a scan task; both passes see the same, which the answers' checks prove.
    step = F.shiftright("place", 33) * (1 << 33) + F.floor(
        F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) / min(per_block, 1 << 20)
    )
    blocks = rows.withColumn("block", step.cast("bigint"))
    answers = store(
        blocks.select("block", "role", "text")
        .mapInPandas(
            _asking(parts),
            "part int, block bigint, keys array<bigint>, counts binary, kept_counts binary",
        )
        .groupBy("part")
        .applyInPandas(_answering, ANSWER),
        "answers",
    )
    # Parts of words come after those of pairs.
    sums = answers.where(F.col("part") >= parts).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SUMMARY]
    ).first()
    found = answers.drop(*SUMMARY).groupBy("block")
    columns = ["block", "place", "doc_id", "role", "text"]
    cases = (
        blocks.select(*columns)
        .groupBy("block")
        .cogroup(found)
        .applyInPandas(
            _deleted_counts(parts, size["kept"]), "pair bigint, context bigint, word bigint, n bigint"
        )
        .groupBy("pair", "context", "word")
        .agg(F.sum("n").alias("n"))
    )
    weights = learn_weights(cases, sums["kept_tokens"], sums["kinds"])
    kind = dict(rows.dtypes)["doc_id"]
    return (
        blocks.select(*columns)
        .groupBy("block")
        .cogroup(found)
        .applyInPandas(
            _scoring(parts, sums["tokens"], sums["kinds"], size["training"], weights),
            f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint,"
            " base_score double, score double",
        )
    )
