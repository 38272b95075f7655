"""Packing of examples into training sequences as vector bin packing.

An example takes up tokens, a segment, and loss-bearing tokens of a sequence,
and a sequence has a limit on each. A sequence is filled with the example whose
demand points most in the direction of the room that is left: the largest dot
product of demand and room, each dimension in units of its limit and weighted
by how scarce it is. Examples are dealt to blocks of bounded size, which are
packed side by side; equal demands of a block are one kind, so a step looks at
each kind once.

Documents become examples by their token ids. A batch of texts is cut at blanks
and each distinct word is tokenised once, which gives the same ids, as no token
of the vocabulary crosses a blank.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import store
from .common import spare

SEQUENCE_TOKENS = 2048

# Segments of a sequence, and tokens in it that bear loss: the first of a segment has nothing
# before it.
SEGMENTS = 64
LOSS_TOKENS = SEQUENCE_TOKENS - 1

END_ID = 1

# Examples that one task packs, about; a sequence id has room for more in a block.
BLOCK = 4096
BLOCK_STRIDE = 1 << 24

# Text that is tokenised at once, and distinct words a worker remembers.
BATCH_BYTES = 8 << 20
CACHED_WORDS = 400_000

BLANK = re.compile(r"[\t-\r ]+")

# How the vocabulary cuts lower-cased ASCII text before merging.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+"
# The same over words that stand on lines of their own.
PARTS = re.compile(rf"{PRE_TOKEN}|\n")
PLAIN = re.compile(r"[!-~]+")
SPECIAL = "<|"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordTokenizer:
    """Ids of texts; remembers those of words, up to a bound."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.forget()

    def forget(self) -> None:
        self.parts: dict[str, list[int]] = {"\n": []}
        self.places: dict[str, int] = {}
        self.ids = np.empty(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 16, np.int64)  # by place of a word, one more than there are
        self.count = 0

    def plain_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words one after the other, and how many each has. Cut at once, merged part by part."""
        found = PARTS.findall("\n".join(words).lower())
        for part in set(found).difference(self.parts):
            self.parts[part] = [t.id for t in self.whole.model.tokenize(part)]
        ids = [self.parts[part] for part in found]
        word = np.cumsum(np.fromiter((part == "\n" for part in found), np.int64, len(found)))
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        counts = np.bincount(word, sizes, minlength=len(words)).astype(np.int64)
        return np.fromiter(chain.from_iterable(ids), np.uint32), counts[: len(words)]

    def learn(self, words: list[str]) -> None:
        """Take up words without blanks that are not known yet."""
        plain, others = [], []
        for word in words:
            (plain if PLAIN.fullmatch(word) and SPECIAL not in word else others).append(word)
        words = plain + others
        flat, counts = self.plain_ids(plain)
        whole = [e.ids for e in self.whole.encode_batch_fast(others, add_special_tokens=False)]
        flat = np.concatenate([flat, np.fromiter(chain.from_iterable(whole), np.uint32)])
        counts = np.concatenate([counts, np.fromiter(map(len, whole), np.int64, len(whole))])
        ends = self.starts[self.count] + np.cumsum(counts)
        while ends[-1] > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while self.count + len(words) >= len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.ids[self.starts[self.count] : ends[-1]] = flat
        self.starts[self.count + 1 : self.count + 1 + len(words)] = ends
        self.places.update(zip(words, range(self.count, self.count + len(words))))
        self.count += len(words)

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text begins and the last ends."""
        if self.count > CACHED_WORDS or len(self.parts) > CACHED_WORDS:
            self.forget()
        lists = pc.ascii_split_whitespace(texts)
        # A text that begins or ends with a blank has an empty word there, of no ids.
        coded = lists.flatten().dictionary_encode()
        # One string of all words is much cheaper to take over than an object for each.
        whole = pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary)
        joined = pc.binary_join(whole, "\n")[0].as_py()
        words = joined.split("\n") if len(coded.dictionary) else []
        get = self.places.get
        found = [get(w, -1) for w in words]
        new = [w for w, place in zip(words, found) if place < 0]
        if new:
            self.learn(new)
            found = [self.places[w] if place < 0 else place for w, place in zip(words, found)]
        place = np.array(found, np.int64)[coded.indices.to_numpy()] if words else np.empty(0, np.int64)
        begin = self.starts[place]
        count = self.starts[place + 1] - begin
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(begin - (ends - count), count)
        at += np.arange(total)
        bounds = np.concatenate([[0], ends])[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        return self.ids[at], bounds


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    """One per worker process, so that words are tokenised once for all its tasks."""
    return WordTokenizer(path)


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Rows that make up a batch of bounded size; a longer text is one by itself."""
    sizes = pc.binary_length(texts).to_numpy()
    first, size = 0, 0
    for k, n in enumerate(sizes):
        if k > first and size + n > BATCH_BYTES:
            yield first, k
            first, size = k, 0
        size += n
    if first < len(sizes):
        yield first, len(sizes)


def _cut_text(text: str) -> list[str]:
    """A very long text in parts that end at blanks, if it has any."""
    parts, at = [], 0
    while len(text) - at > BATCH_BYTES:
        found = BLANK.search(text, at + BATCH_BYTES)
        if found is None:
            break
        parts.append(text[at : found.start()])
        at = found.end()
    return [*parts, text[at:]]


def _ids_by_row(texts: pa.Array, known: WordTokenizer) -> Iterator[np.ndarray]:
    """Ids of each text."""
    for first, end in _slices(texts):
        part = texts.slice(first, end - first)
        if end - first == 1 and pc.binary_length(part)[0].as_py() > BATCH_BYTES:
            cut = _cut_text(part[0].as_py())
            yield np.concatenate([known.texts(pa.array([t]))[0] for t in cut])
            continue
        ids, bounds = known.texts(part)
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            yield ids[a:b]


PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def pieces(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    tokens: int = SEQUENCE_TOKENS,
    path: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """Token ids of every row of ``docs``, an end id after them, in pieces of ``tokens`` at most.

    A row per piece: ``start`` (ids of the document before it), ``length``, the
    CRC of the ids as little-endian unsigned 32-bit numbers, ``doc_tokens`` (of
    the whole document, with the end id), and the ids themselves if asked for.
    An empty text, or NULL, is the end id alone. Other columns are ignored.
    """
    file = path or tokenizer_path()
    source = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    fields = PIECES + (", ids array<bigint>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_tokenizer(file)
        end = np.array([END_ID], np.uint32)
        for batch in batches:
            texts = batch["text"].cast(pa.string())
            rows: list[tuple] = []
            for k, found in enumerate(_ids_by_row(texts, known)):
                ids = np.concatenate([found, end])
                for start in range(0, len(ids), tokens):
                    part = ids[start : start + tokens]
                    row = (k, start, len(part), zlib.crc32(part.astype("<u4").tobytes()), len(ids))
                    rows.append((*row, part.astype(np.int64)) if with_ids else row)
            columns = list(zip(*rows)) or [[]] * (6 if with_ids else 5)
            kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())] * with_ids
            made = [pa.array(c, t) for c, t in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(made[0]), *made[1:]],
                [f.split()[0] for f in fields.split(", ")],
            )

    return source.mapInArrow(run, fields)


def fill_sequences(demands: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence of each example, and its rank there, by the dot-product rule.

    ``demands`` has a row per example and a column per limit. An example over a
    limit by itself gets a sequence of its own. Ties fall to the larger example
    in the first column, and examples of equal demand are taken in order.
    """
    sequence = np.full(len(demands), -1, np.int64)
    rank = np.zeros(len(demands), np.int64)
    alone = np.flatnonzero((demands > limits).any(axis=1) | (demands[:, 0] == limits[0]))
    sequence[alone] = np.arange(len(alone))
    made = len(alone)
    rest = np.flatnonzero(sequence < 0)
    if not len(rest):
        return sequence, rank
    kinds, member, left = np.unique(
        demands[rest], axis=0, return_inverse=True, return_counts=True
    )
    # Largest first, so that the first of equal dot products is the largest.
    kinds, left = kinds[::-1], left[::-1].copy()
    member = len(kinds) - 1 - member.ravel()
    order = np.argsort(member, kind="stable")
    queue = np.concatenate([[0], np.cumsum(left)])[:-1]  # next example of each kind
    by_kind = rest[order]
    unit = kinds / limits
    scarce = unit.T @ left / max(1, len(rest))
    weighted = unit * (scarce / limits)
    open_kinds = np.arange(len(kinds))
    while len(open_kinds):
        room, at = limits.astype(np.int64).copy(), 0
        here = open_kinds
        while len(here):
            best = here[np.argmax(weighted[here] @ room)]
            example = by_kind[queue[best]]
            queue[best] += 1
            left[best] -= 1
            sequence[example], rank[example] = made, at
            at += 1
            room -= kinds[best]
            if not left[best]:
                here = here[here != best]
            here = here[(kinds[here] <= room).all(axis=1)]
        made += 1
        open_kinds = open_kinds[left[open_kinds] > 0]
    return sequence, rank


def pack(
    examples: DataFrame,
    tokens: str = "length",
    loss: str | None = None,
    most_tokens: int = SEQUENCE_TOKENS,
    most_segments: int = SEGMENTS,
    most_loss: int = LOSS_TOKENS,
    block: int = BLOCK,
) -> DataFrame:
    """``examples`` with ``sequence_id`` and ``offset``, its tokens before this one.

    No sequence exceeds ``most_tokens``, ``most_segments`` or ``most_loss`` of
    the column ``loss``; without one, all tokens of an example but the first
    bear loss. An example over a limit by itself is alone in its sequence. NULL
    counts as 0. Rows that are equal are examples of their own; an empty table
    stays empty. Columns named like the result give way to it.

    Rows are stored and dealt to blocks by their place, so any value may be
    common; a block is a task's work and about ``block`` rows. Ids of sequences
    are unique, and have gaps between blocks.
    """
    own = [c for c in examples.columns if c.lower() not in ("sequence_id", "offset")]
    size = F.coalesce(F.col(f"`{tokens}`").cast("long"), F.lit(0))
    bearing = F.greatest(size - 1, F.lit(0))
    if loss is not None:
        bearing = F.coalesce(F.col(f"`{loss}`").cast("long"), F.lit(0))
    n_tokens, n_loss, place, part = names = spare(examples, "tokens", "loss", "place", "block")
    kept = store(
        examples.select(*[f"`{c}`" for c in own], size.alias(n_tokens), bearing.alias(n_loss)),
        "examples",
    )
    blocks = max(1, -(-kept.count() // block))
    dealt = kept.withColumn(place, F.monotonically_increasing_id()).withColumn(
        part, F.pmod(F.xxhash64(place), F.lit(blocks))
    )
    limits = np.array([most_tokens, most_segments, most_loss], np.int64)
    kinds = ", ".join(f"`{n}` {t}" for n, t in examples.select(*[f"`{c}`" for c in own]).dtypes)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(place)
        n = table.num_rows
        size = table[n_tokens].to_numpy()
        sequence, rank = fill_sequences(
            np.column_stack([size, np.ones(n, np.int64), table[n_loss].to_numpy()]), limits
        )
        order = np.lexsort([rank, sequence])
        before = np.cumsum(size[order]) - size[order]
        firsts = np.flatnonzero(np.diff(sequence[order], prepend=-1))
        offset = np.empty(n, np.int64)
        offset[order] = before - np.repeat(before[firsts], np.diff(np.append(firsts, n)))
        first_id = table[part][0].as_py() * BLOCK_STRIDE
        table = table.drop_columns(names)
        return table.append_column("sequence_id", pa.array(first_id + sequence)).append_column(
            "offset", pa.array(offset)
        )

    return dealt.groupBy(part).applyInArrow(run, f"{kinds}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of every row of ``docs`` in sequences of SEQUENCE_TOKENS at most."""
    return pack(pieces(docs, doc_id, text))
