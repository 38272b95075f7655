"""Fill-in-middle transformation over a Roaring-style set of token boundaries.

A text may only be cut between tokens. The places between tokens form a set of
code point offsets, kept in containers of 2**16 places each: a sorted array, a
bitmap or a list of runs, whichever is smallest. Cumulative cardinalities tell
which container holds the k-th boundary; inside it a select by rank gives the
offset. So both cuts of a text cost two searches, however long it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import spare

CONTAINER_BITS = 16

# Marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

# Of a hundred texts: those that are transformed, and those of them with the suffix first.
RATE, SUFFIX_FIRST = 90, 20
SEED = 1

BATCH_ROWS = 1024


@dataclass(frozen=True)
class ArrayContainer:
    """Few places: the places themselves, ascending."""

    places: np.ndarray  # uint16

    def select(self, rank: int) -> int:
        return int(self.places[rank])


@dataclass(frozen=True)
class BitmapContainer:
    """Many scattered places: a bit each, and how many there are up to each word."""

    words: np.ndarray  # uint64
    counts: np.ndarray

    def select(self, rank: int) -> int:
        word = int(np.searchsorted(self.counts, rank, "right"))
        left = rank - (int(self.counts[word - 1]) if word else 0)
        bits = np.unpackbits(self.words[word : word + 1].view(np.uint8), bitorder="little")
        return 64 * word + int(np.flatnonzero(bits)[left])


@dataclass(frozen=True)
class RunContainer:
    """Places next to each other: first places of runs, and how many there are up to each."""

    starts: np.ndarray
    counts: np.ndarray

    def select(self, rank: int) -> int:
        run = int(np.searchsorted(self.counts, rank, "right"))
        return int(self.starts[run]) + rank - (int(self.counts[run - 1]) if run else 0)


Container = ArrayContainer | BitmapContainer | RunContainer


def container(low: np.ndarray, bits: int = CONTAINER_BITS) -> Container:
    """The smallest container for ascending places below ``2**bits``; an array in a tie."""
    first = np.flatnonzero(np.diff(low, prepend=-2) != 1)
    array, bitmap, runs = 2 * len(low), (1 << bits) // 8, 4 * len(first)
    if array <= bitmap and array <= runs:
        return ArrayContainer(low.astype(np.uint16))
    if runs <= bitmap:
        ends = np.append(first[1:], len(low))
        return RunContainer(low[first], ends)
    flags = np.zeros(max(64, 1 << bits), np.uint8)
    flags[low] = 1
    words = np.packbits(flags, bitorder="little").view(np.uint64)
    return BitmapContainer(words, np.cumsum(np.bitwise_count(words), dtype=np.int64))


class BoundarySet:
    """Ascending offsets in containers, found by rank."""

    def __init__(self, offsets: np.ndarray, bits: int = CONTAINER_BITS):
        self.bits = bits
        high = offsets >> bits
        cuts = np.flatnonzero(np.diff(high)) + 1
        starts = np.concatenate([[0], cuts]) if len(offsets) else np.empty(0, np.int64)
        self.keys = high[starts] if len(offsets) else high
        self.containers = [
            container(part & ((1 << bits) - 1), bits) for part in np.split(offsets, cuts)
        ] if len(offsets) else []
        self.cumulative = np.append(cuts, len(offsets)) if len(offsets) else np.empty(0, np.int64)

    def __len__(self) -> int:
        return int(self.cumulative[-1]) if len(self.cumulative) else 0

    def select(self, rank: int) -> int:
        """The offset with ``rank`` smaller ones."""
        at = int(np.searchsorted(self.cumulative, rank, "right"))
        before = int(self.cumulative[at - 1]) if at else 0
        return (int(self.keys[at]) << self.bits) + self.containers[at].select(rank - before)


def boundaries(text: str) -> np.ndarray:
    """Offsets between tokens: both ends, and any place that is not inside a run of A-Z, a-z."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = ((points | 32) - 97) < 26
    free = np.ones(len(points) + 1, bool)
    free[1:-1] = ~(letter[1:] & letter[:-1])
    return np.flatnonzero(free)


def draws(doc_id: int | None, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four numbers below 2**32 that depend on ``seed`` and id alone; no id counts as none."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    digest = hashlib.sha256(name.encode()).digest()
    return tuple(int.from_bytes(digest[k : k + 4]) for k in range(0, 16, 4))


def transform(
    text: str, numbers: tuple[int, int, int, int], rate: int = RATE, suffix_first: int = SUFFIX_FIRST
) -> tuple[int, str, int | None, int | None, str]:
    """Number of tokens, form, code points of prefix and middle, and output of a text."""
    found = BoundarySet(boundaries(text))
    n = len(found) - 1
    first, second, chance, order = numbers
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or chance % 100 >= rate:
        return n, "plain", None, None, text
    start, end = (found.select(k) for k in sorted((first % (n + 1), second % (n + 1))))
    prefix, middle, suffix = text[:start], text[start:end], text[end:]
    if order % 100 < suffix_first:
        return n, "spm", start, end - start, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", start, end - start, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


COLUMNS = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
KINDS = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
NAMES = ("n", "form", "prefix_chars", "middle_chars", "output")


def fill_in_middle(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    seed: int = SEED,
    rate: int = RATE,
    suffix_first: int = SUFFIX_FIRST,
) -> DataFrame:
    """``docs`` without its text, with the transformed text as ``output``.

    Of a text of ``n`` tokens prefix, middle and suffix are cut at two of its
    n + 1 token boundaries, drawn from id and seed. ``form`` is ``psm``, ``spm``
    (suffix first) or ``plain``: an empty text (NULL counts as one), one that
    holds a mark, and those the rate leaves out stay as they are, and have no
    ``prefix_chars`` and ``middle_chars``. A row without id is drawn like any
    other, by an empty name; equal rows give equal rows; an empty table stays
    empty. Columns of ``docs`` named like one of the result give way to it.
    """
    others = [c for c in docs.columns if c != text and c.lower() not in NAMES]
    name, content = spare(docs, "name", "content")
    source = docs.select(
        *[f"`{c}`" for c in others],
        F.col(f"`{doc_id}`").alias(name),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(content),
    )
    kept = ", ".join(f"`{n}` {t}" for n, t in docs.select(*[f"`{c}`" for c in others]).dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                rows = [
                    transform(t, draws(i, seed), rate, suffix_first)
                    for i, t in zip(batch[name].to_pylist(), batch[content].to_pylist())
                ]
                made = [pa.array(c, k) for c, k in zip(zip(*rows), KINDS)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch[c] for c in others), *made], [*others, *NAMES]
                )

    return source.mapInArrow(run, f"{kept}, {COLUMNS}" if kept else COLUMNS)


def restored(output: Column, form: Column) -> Column:
    """The text that an output of a form was made from."""

    def after(value: Column, mark: str) -> Column:
        """What follows the first ``mark``, or nothing."""
        at = F.locate(mark, value)
        return F.when(at > 0, F.substring(value, at + len(mark), F.length(value))).otherwise("")

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        rest = after(output, first)
        tail = after(rest, second)
        return (
            F.substring_index(rest, second, 1),
            F.substring_index(tail, MIDDLE, 1),
            after(tail, MIDDLE),
        )

    prefix, suffix, middle = parts(PREFIX, SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(SUFFIX, PREFIX)
    spm = F.concat(prefix, middle, suffix)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
