"""SentencePiece encoding with the N best segmentations, and decoding.

A text is a lattice of pieces. Going forward, Viterbi finds the best score of
every place. Going backward from the end, these scores are what is left to
gain at most, and exactly so, which makes them a heuristic for A*: complete
segmentations come off the queue in order of their scores, and nothing is
expanded that is not needed for the N best.

No piece has a space after another character, which is checked, so the lattice of
a text hangs together at single places, one before each word. The forward scores
of all new words of a batch are found at once, over one array of their characters,
and kept by word. The best path is read off these scores, as A* would; the N best
of the whole text are merged from those of its words, again best first.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BEST = 3
SPACE = "▁"
CACHED_WORDS = 700_000

# Below any piece of the model, so that bytes are used only where no piece fits.
BYTE_PENALTY = 10.0

# Room for any character beside the number of a state.
CODE_BITS = 21

# Words searched at once, and the longest of them; longer ones are searched by themselves.
AT_ONCE = 20_000
LONG_WORD = 64

UNIT = re.compile(f"{SPACE}*[^{SPACE}]*", re.S)


@dataclass
class Vocabulary:
    """Pieces with ids and log-probabilities, byte pieces, and the unknown one."""

    ids: dict[str, int]
    scores: list[float]
    pieces: list[str]
    bytes: dict[int, int] = field(default_factory=dict)  # of byte, its id
    unknown: int = 0
    longest: int = 0

    def __post_init__(self):
        self.longest = max(map(len, self.ids), default=1)
        self.byte_of = {i: b for b, i in self.bytes.items()}
        # Bytes below 128 are characters by themselves, also between others.
        self.texts = [chr(self.byte_of[i]) if self.byte_of.get(i, 128) < 128 else p for i, p in enumerate(self.pieces)]
        self.parts_of_characters = {i for i, b in self.byte_of.items() if b >= 128}
        # Every beginning of a piece; -1 if it is no piece itself.
        self.begun = {p[:k]: -1 for p in self.ids for k in range(1, len(p))} | self.ids
        self.worst = min((self.scores[i] for i in self.ids.values()), default=0.0) - BYTE_PENALTY
        inside = [p for p in self.ids if re.search(f"[^{SPACE}]{SPACE}", p)]
        if inside:
            raise ValueError(f"pieces that go beyond a word: {inside[:3]}")
        # The same beginnings as numbered states, 0 before the first character.
        states = {p: k for k, p in enumerate(self.begun, 1)} | {"": 0}
        steps = sorted((states[p[:-1]] << CODE_BITS | ord(p[-1]), k) for p, k in states.items() if p)
        self.steps = np.array([s for s, _ in steps], np.int64)
        self.reached = np.array([k for _, k in steps], np.int64)
        self.piece_of = np.array([-1, *self.begun.values()], np.int64)
        self.score_of = np.array(self.scores)

    def uncovered(self, character: str) -> tuple[tuple[int, ...], float]:
        """Ids and score of a character that is no piece."""
        if not self.bytes:
            return (self.unknown,), self.worst
        ids = tuple(self.bytes[b] for b in character.encode("utf-8", "replace"))
        return ids, self.worst * len(ids)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """Read a SentencePiece model file.

    A unigram model has log-probabilities. In a BPE model scores are ranks of
    merges; the piece of rank r is then taken to have the probability of that
    rank under Zipf's law. Pieces of which the model knows no rank, runs of
    spaces and single characters at its end, get the last rank.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(size)]
    raw = [model.get_score(i) for i in range(size)]
    normal = [
        i
        for i in range(size)
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    ranked = all(raw[i] <= -1.0 or raw[i] == 0.0 for i in normal) and all(
        float(raw[i]).is_integer() for i in normal
    )
    scores = [0.0] * size
    total = math.log(sum(1 / (r + 1) for r in range(1, size + 1)))
    for i in normal:
        scores[i] = -math.log(min(-raw[i], size) + 1) - total if ranked else raw[i]
    return Vocabulary(
        {pieces[i]: i for i in normal},
        scores,
        pieces,
        {int(pieces[i][3:5], 16): i for i in range(size) if model.is_byte(i)},
        model.unk_id(),
    )


def edges(text: str, vocab: Vocabulary) -> list[list[tuple[int, tuple[int, ...], float]]]:
    """By end: start, ids and score of every piece of ``text``.

    A character no piece covers is its bytes if the model has them, else unknown.
    """
    n = len(text)
    into: list[list[tuple[int, tuple[int, ...], float]]] = [[] for _ in range(n + 1)]
    for start in range(n):
        single = False
        for end in range(start + 1, min(n, start + vocab.longest) + 1):
            piece = vocab.begun.get(text[start:end])
            if piece is None:
                break
            if piece >= 0:
                into[end].append((start, (piece,), vocab.scores[piece]))
                single |= end == start + 1
        if not single:
            into[start + 1].append((start, *vocab.uncovered(text[start])))
    return into


def best_paths(text: str, vocab: Vocabulary, count: int) -> list[tuple[float, tuple[int, ...]]]:
    """The ``count`` best segmentations as score and ids, best first, fewer if there are no more.

    Equal scores come in the order of their discovery, which depends on the
    text alone.
    """
    n = len(text)
    into = edges(text, vocab)
    forward = [0.0] + [-math.inf] * n
    for end in range(1, n + 1):
        forward[end] = max(forward[start] + score for start, _, score in into[end])
    # What is best at most, order of making, place, score so far, pieces from here on.
    queue = [(-forward[n], 0, n, 0.0, None)]
    made, found = 1, []
    while queue and len(found) < count:
        _, _, place, gained, pieces = heapq.heappop(queue)
        if place == 0:
            ids = []
            while pieces:
                ids.extend(pieces[0])
                pieces = pieces[1]
            found.append((gained, tuple(ids)))
            continue
        for start, ids, score in into[place]:
            more = gained + score
            heapq.heappush(queue, (-(forward[start] + more), made, start, more, (ids, pieces)))
            made += 1
    return found


def best_and_loss(text: str, vocab: Vocabulary) -> tuple[float, tuple[int, ...], float]:
    """Score and ids of the best segmentation, and what the next best loses against it.

    The best path through an edge is the forward score of its start, its own,
    and the backward score of its end; any other segmentation has an edge that
    the best has not.
    """
    n, get, scores, longest = len(text), vocab.begun.get, vocab.scores, vocab.longest
    forward, back = [0.0] + [-math.inf] * n, [(0, (0,))] * (n + 1)
    found: list[tuple[int, int, float]] = []
    for start in range(n):
        here, single = forward[start], False
        for end in range(start + 1, min(n, start + longest) + 1):
            piece = get(text[start:end])
            if piece is None:
                break
            if piece >= 0:
                score = scores[piece]
                found.append((start, end, score))
                single |= end == start + 1
                if here + score > forward[end]:
                    forward[end], back[end] = here + score, (start, (piece,))
        if not single:
            ids, score = vocab.uncovered(text[start])
            found.append((start, start + 1, score))
            if here + score > forward[start + 1]:
                forward[start + 1], back[start + 1] = here + score, (start, ids)
    parts, path, end = [], {}, n
    while end:
        path[end] = back[end][0]
        parts.append(back[end][1])
        end = back[end][0]
    rest = [-math.inf] * n + [0.0]
    for start, end, score in reversed(found):
        if score + rest[end] > rest[start]:
            rest[start] = score + rest[end]
    other = -math.inf
    for start, end, score in found:
        whole = forward[start] + score + rest[end]
        if whole > other and path.get(end) != start:
            other = whole
    return forward[n], tuple(i for part in reversed(parts) for i in part), max(0.0, forward[n] - other)


def _first_best(values: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of runs of equal ``ends``: where the first greatest value of each is, and where each begins."""
    begins = np.flatnonzero(np.r_[True, ends[1:] != ends[:-1]])
    greatest = np.maximum.reduceat(values, begins)
    sizes = np.diff(np.r_[begins, len(ends)])
    at = np.flatnonzero(values == np.repeat(greatest, sizes))
    return at[np.searchsorted(at, begins)], begins


def best_of_words(
    words: Sequence[str], vocab: Vocabulary
) -> list[tuple[float, tuple[int, ...], float]]:
    """:func:`best_and_loss` of many words at once.

    The places of all words are numbered through, so a step of the search is one
    operation on the arrays of all words.
    """
    sizes = np.array([len(w) for w in words], np.int64)
    if not sizes.all() or not len(vocab.steps):
        return [best_and_loss(w, vocab) for w in words]
    if not len(words):
        return []
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    word = np.repeat(np.arange(len(words)), sizes)
    firsts = np.cumsum(sizes) - sizes
    local = np.arange(len(codes)) - firsts[word]
    room = sizes[word] - local
    # Edges: from each place, all pieces that begin there.
    at, state, length, found = np.arange(len(codes)), np.zeros(len(codes), np.int64), 0, []
    while len(at):
        wanted = state << CODE_BITS | codes[at + length]
        place = np.minimum(np.searchsorted(vocab.steps, wanted), len(vocab.steps) - 1)
        known = vocab.steps[place] == wanted
        at, state, length = at[known], vocab.reached[place[known]], length + 1
        ids = vocab.piece_of[state]
        whole = ids >= 0
        found.append((at[whole], np.full(whole.sum(), length), ids[whole]))
        more = room[at] > length
        at, state = at[more], state[more]
    start, span, ids = (np.concatenate(x) for x in zip(*found))
    # A character that is no piece is an edge with a number below zero.
    covered = np.zeros(len(codes), bool)
    covered[found[0][0]] = True
    bare = np.flatnonzero(~covered)
    code = codes[bare]
    units = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF) if vocab.bytes else np.ones(len(bare))
    scores = np.r_[vocab.score_of[ids], vocab.worst * units]
    start, span = np.r_[start, bare], np.r_[span, np.ones(len(bare), np.int64)]
    ids, of = np.r_[ids, -1 - code], word[start]
    # Nodes: the places of a word and its end.
    tail, node = local[start], start + of
    head = node + span
    n_nodes = len(codes) + len(words)
    forward = np.full(n_nodes, -math.inf)
    forward[(firsts + np.arange(len(words)))] = 0.0
    back = np.zeros(n_nodes, np.int64)
    order = np.lexsort((node, head, tail + span))
    for edge in np.split(order, np.flatnonzero(np.diff((tail + span)[order])) + 1):
        if len(edge):
            gained = forward[node[edge]] + scores[edge]
            best, begins = _first_best(gained, head[edge])
            forward[head[edge[begins]]], back[head[edge[begins]]] = gained[best], edge[best]
    rest = np.full(n_nodes, -math.inf)
    last = firsts + np.arange(len(words)) + sizes
    rest[last] = 0.0
    order = np.lexsort((head, node, -tail))
    for edge in np.split(order, np.flatnonzero(np.diff(tail[order])) + 1):
        if len(edge):
            left = scores[edge] + rest[head[edge]]
            begins = np.flatnonzero(np.r_[True, np.diff(node[edge]) != 0])
            rest[node[edge[begins]]] = np.maximum.reduceat(left, begins)
    taken = np.zeros(len(start), bool)
    here = last
    while len(here):
        edge = back[here]
        taken[edge] = True
        here = node[edge][tail[edge] > 0]
    other = np.full(len(words), -math.inf)
    np.maximum.at(other, of[~taken], (forward[node] + scores + rest[head])[~taken])
    path = np.flatnonzero(taken)
    path = path[np.argsort(node[path])]
    pieces, bounds = ids[path].tolist(), np.searchsorted(of[path], np.arange(len(words) + 1)).tolist()
    score = forward[last]
    with np.errstate(invalid="ignore"):
        loss = np.maximum(0.0, score - other).tolist()
    out = []
    for k, (s, x) in enumerate(zip(score.tolist(), loss)):
        own = tuple(pieces[bounds[k] : bounds[k + 1]])
        if own and min(own) < 0:
            own = tuple(chain.from_iterable((i,) if i >= 0 else vocab.uncovered(chr(-1 - i))[0] for i in own))
        out.append((s, own, x))
    return out


class Change(NamedTuple):
    """In the best segmentation, ``removed`` ids from ``start`` on give way to ``ids`` of the same word."""

    start: int
    removed: int
    ids: tuple[int, ...]
    unit: str


class Encoder:
    """N best segmentations of texts; keeps what it knows of words, up to a bound."""

    def __init__(self, vocab: Vocabulary, count: int):
        self.vocab, self.count = vocab, count
        self.best: dict[str, tuple[float, tuple[int, ...], float]] = {}
        self.older = self.best
        self.several: dict[str, list[tuple[float, tuple[int, ...]]]] = {}

    def units(self, text: str) -> list[str]:
        """Words of a text with the spaces before them; a space is put before the text."""
        found = UNIT.findall(SPACE + text.replace(" ", SPACE)) if text else []
        return found if found and found[-1] else found[:-1]

    def learn(self, units: Iterable[str]) -> None:
        """Search the words that are not known yet, many at once."""
        best, older = self.best, self.older
        new = [u for u in dict.fromkeys(units) if u not in best and u not in older and len(u) <= LONG_WORD]
        for k in range(0, len(new), AT_ONCE):
            part = new[k : k + AT_ONCE]
            for unit, found in zip(part, best_of_words(part, self.vocab)):
                self.keep(unit, found)

    def keep(self, unit: str, found: tuple[float, tuple[int, ...], float]) -> None:
        if len(self.best) >= CACHED_WORDS // 2:
            self.best, self.older = {}, self.best
        self.best[unit] = found

    def word(self, unit: str) -> tuple[float, tuple[int, ...], float]:
        found = self.best.get(unit)
        if found is None:
            # What is met again survives when the older half is forgotten.
            found = self.older.get(unit) or best_and_loss(unit, self.vocab)
            if len(unit) <= LONG_WORD:
                self.keep(unit, found)
        return found

    def word_paths(self, unit: str) -> list[tuple[float, tuple[int, ...]]]:
        """The N best segmentations of a word; the first is that of :meth:`word`, also in a tie."""
        found = self.several.get(unit)
        if found is None:
            found = best_paths(unit, self.vocab, self.count)
            score, ids, _ = self.word(unit)
            others = [x for x in found if x[1] != ids]
            found = [(score, ids), *others][: self.count]
            if len(unit) <= LONG_WORD:
                if len(self.several) >= CACHED_WORDS // 10:
                    self.several.clear()
                self.several[unit] = found
        return found

    def text(self, units: Sequence[str]) -> list[tuple[float, list[int], list[Change]]]:
        """Score, ids of the best segmentation (first entry only), and changes of it.

        Only the words that lose least by their next choice can differ among
        the N best, so only these are searched for more and merged.
        """
        get, word = self.best.get, self.word
        words = [get(u) or word(u) for u in units]
        ids: list[int] = list(chain.from_iterable([w[1] for w in words]))
        score = math.fsum([w[0] for w in words])
        losses = [w[2] for w in words]
        places: list[int] = []
        for _ in range(min(self.count - 1, len(losses))):
            least = min(losses)
            if least == math.inf:
                break
            places.append(losses.index(least))
            losses[places[-1]] = math.inf
        paths = [self.word_paths(units[k]) for k in places]
        before = [sum([len(w[1]) for w in words[:k]]) for k in places]
        out: list[tuple[float, list[int], list[Change]]] = [(score, ids, [])]
        queue: list[tuple[float, int, tuple[int, ...]]] = []
        start = (0,) * len(places)
        seen, made = {start}, 0

        def push(choice: tuple[int, ...]) -> None:
            nonlocal made
            for k, c in enumerate(choice):
                later = choice[:k] + (c + 1,) + choice[k + 1 :]
                if later not in seen and c + 1 < len(paths[k]):
                    seen.add(later)
                    loss = math.fsum(p[0][0] - p[x][0] for p, x in zip(paths, later) if x)
                    made += 1
                    heapq.heappush(queue, (loss, made, later))

        push(start)
        while queue and len(out) < self.count:
            loss, _, choice = heapq.heappop(queue)
            changes = [
                Change(before[k], len(paths[k][0][1]), paths[k][x][1], units[places[k]])
                for k, x in enumerate(choice)
                if x
            ]
            out.append((score - loss, [], sorted(changes)))
            push(choice)
        return out


def decode(ids: Sequence[int], vocab: Vocabulary) -> str:
    """The text of a segmentation; a lossless one for any text with byte pieces."""
    text = _joined(ids, vocab)
    return text[1:] if text.startswith(" ") else text


def _joined(ids: Sequence[int], vocab: Vocabulary) -> str:
    """What the pieces say, spaces included."""
    if vocab.parts_of_characters.isdisjoint(ids):
        return "".join(map(vocab.texts.__getitem__, ids)).replace(SPACE, " ")
    parts, held = [], bytearray()
    for i in ids:
        byte = vocab.byte_of.get(i)
        if byte is not None:
            held.append(byte)
            continue
        if held:
            parts.append(held.decode("utf-8", "replace"))
            held.clear()
        parts.append(vocab.pieces[i])
    if held:
        parts.append(held.decode("utf-8", "replace"))
    return "".join(parts).replace(SPACE, " ")


SCHEMA = (
    "ids array<int>, n_pieces array<bigint>, scores array<double>,"
    " changes array<array<struct<start:int,removed:int,ids:array<int>>>>, round_trip boolean"
)
NAMES = ("ids", "n_pieces", "scores", "changes", "round_trip")
CHANGE = pa.struct([("start", pa.int32()), ("removed", pa.int32()), ("ids", pa.list_(pa.int32()))])
KINDS = (
    pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.float64()),
    pa.list_(pa.list_(CHANGE)), pa.bool_(),
)
BATCH_ROWS = 256


def _row(encoder: Encoder, vocab: Vocabulary, text: str, units: Sequence[str]) -> tuple:
    """The columns of SCHEMA for a text.

    The best segmentation is decoded as a whole. Another one differs from it by
    whole words, so decoding it gives the text if the changed words come back.
    """
    found = encoder.text(units)
    best = found[0][1]
    return (
        np.array(best, np.int32),
        [len(best) + sum(len(c.ids) - c.removed for c in changes) for _, _, changes in found],
        [s for s, _, _ in found],
        [
            [{"start": c.start, "removed": c.removed, "ids": c.ids} for c in changes]
            for _, _, changes in found
        ],
        decode(best, vocab) == text
        and all(
            _joined(c.ids, vocab) == c.unit.replace(SPACE, " ") for _, _, changes in found for c in changes
        ),
    )


def segmentations(ids: Column, changes: Column) -> Column:
    """Ids of all segmentations of a row of :func:`encode`, best first, from its columns alone."""

    def changed(so_far: Column, change: Column) -> Column:
        after = change["start"] + change["removed"] + 1
        return F.concat(
            F.slice(so_far, F.lit(1), change["start"]),
            change["ids"],
            F.slice(so_far, after, F.greatest(F.size(so_far) - after + 1, F.lit(0))),
        )

    # The last change first, so that the places of the others still hold.
    return F.transform(changes, lambda c: F.aggregate(F.reverse(c), ids, changed))


def encode(
    docs: DataFrame, text: str = "text", count: int = BEST, model: str = MODEL
) -> DataFrame:
    """``docs`` without its text, with the ``count`` best segmentations of each.

    ``ids`` are those of the best. ``n_pieces``, ``scores`` and ``changes`` have an
    entry per segmentation, best first. ``changes`` are the runs of ``ids`` another
    one replaces, with the ids it has there; :func:`segmentations` applies them.
    ``round_trip`` tells whether decoding every segmentation gives the text back: it
    does unless the text itself has the mark that stands for a space. NULL is an
    empty text, which has one segmentation without pieces. Equal texts give equal
    rows. A column of ``docs`` named like one of these is kept with ``_`` before
    its name, as many as it takes.
    """
    given = [c for c in docs.columns if c != text]
    others: list[str] = []
    for c in given:
        while c.lower() in NAMES or c in others or c != given[len(others)] and c in given:
            c = f"_{c}"
        others.append(c)
    source_text = "_text"
    while source_text in others:
        source_text = f"_{source_text}"
    source = docs.select(
        *[F.col(f"`{c}`").alias(o) for c, o in zip(given, others)],
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(source_text),
    )
    kinds = ", ".join(f"`{n}` {t}" for n, t in source.drop(source_text).dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, encoder = vocabulary(model), _encoder(model, count)
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(start, BATCH_ROWS)
                texts = batch[source_text].to_pylist()
                units = [encoder.units(t) for t in texts]
                encoder.learn(chain.from_iterable(units))
                rows = [_row(encoder, vocab, t, u) for t, u in zip(texts, units)]
                made = [pa.array(c, k) for c, k in zip(zip(*rows), KINDS)] or [
                    pa.array([], k) for k in KINDS
                ]
                yield pa.RecordBatch.from_arrays(
                    [*(batch[c] for c in others), *made], [*others, *NAMES]
                )

    return source.mapInArrow(run, f"{kinds}, {SCHEMA}" if kinds else SCHEMA)


@lru_cache(maxsize=2)
def _encoder(model: str, count: int) -> Encoder:
    """One per worker process, so that words are searched once for all its tasks."""
    return Encoder(vocabulary(model), count)
