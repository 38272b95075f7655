"""Prefix trie of conversations from double arrays of shards.

A node is a sequence of first turns; its members are the conversations that
begin with it. Turns are numbered and hashed in blocks of the ordered table, so
one endless conversation is spread over tasks, and a node's key is the XOR of
the hashes of its turns with their depths, which blocks can be joined by. Equal
conversations are one class with a count from then on.

Classes are dealt to shards by prefix. A shard is packed into a double array,
BASE and CHECK, over turn ids that are dense in the shard, and walked by all
its classes level by level to find members, children, leaves and sums of each
node. A prefix with too much below it is dealt by a longer one, so a common
first turn does not meet in one task; nodes above the prefixes of shards are
shared, and what shards found for them is merged by key. What follows the last
branch of a class is a tail, which needs no array. Long conversations that stay
together are handled a stretch of turns at a time, the deepest first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.ordering import BLOCK, POSITION, ordered_blocks
from ..session import store

# Turns of a stretch, and turns that a shard holds, about.
STRETCH = 128
SHARD_TURNS = 100_000

# Conversations that share the beginning of their first, and the bound of how many turns.
FAMILY, MOST_HEAD = 5, 9

# Characters of a list of ids that are hashed at once.
CHUNK = 1 << 16

NO_ENDS = hashlib.sha256(b"").hexdigest()


class DoubleArray:
    """A trie whose nodes are slots: the child of ``s`` by ``c`` is BASE[s] + c if CHECK there is s."""

    def __init__(self):
        self.base = np.zeros(64, np.int64)
        self.check = np.full(64, -1, np.int64)
        self.check[0] = 0  # the root
        self.low = 1  # no free slot below
        self.top = 1  # no used slot from here on

    def _reserve(self, size: int) -> None:
        while size > len(self.check):
            self.base = np.concatenate([self.base, np.zeros_like(self.base)])
            self.check = np.concatenate([self.check, np.full_like(self.check, -1)])

    def _fit(self, symbols: np.ndarray) -> int:
        """First slot at which ascending ``symbols`` find free slots, as apart as they are."""
        apart = symbols - symbols[0]
        self._reserve(self.top + int(apart[-1]) + 1)
        step = max(1, (1 << 16) // len(apart))
        at = self.low
        while at < self.top:
            free = at + np.flatnonzero(self.check[at : min(self.top, at + step)] < 0)
            fits = (self.check[free[:, None] + apart] < 0).all(axis=1)
            if fits.any():
                return int(free[np.argmax(fits)])
            at += step
        return self.top

    def add(self, parents: np.ndarray, symbols: np.ndarray) -> None:
        """Children of slots that have none yet; pairs ascend by parent, then symbol."""
        first = np.flatnonzero(np.diff(parents, prepend=-1))
        count = np.diff(np.append(first, len(parents)))
        # Those with most children first, while there is most room.
        for k in first[count > 1][np.argsort(-count[count > 1], kind="stable")]:
            end = k + int(np.searchsorted(parents[k:], parents[k], "right"))
            own = symbols[k:end]
            at = self._fit(own)
            slots = at + own - own[0]
            self.base[parents[k]] = at - own[0]
            self.check[slots] = parents[k]
            self.top = max(self.top, int(slots[-1]) + 1)
        single = first[count == 1]
        if len(single):
            self._reserve(self.top + len(single))
            slots = self.low + np.flatnonzero(self.check[self.low : self.top + len(single)] < 0)
            slots = slots[: len(single)]
            self.base[parents[single]] = slots - symbols[single]
            self.check[slots] = parents[single]
            self.top = max(self.top, int(slots[-1]) + 1)
        free = np.flatnonzero(self.check[self.low : self.top] < 0)
        self.low = self.low + int(free[0]) if len(free) else self.top

    def step(self, slots: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Children of slots by symbols; -1 where there is none."""
        to = self.base[slots] + symbols
        there = (slots >= 0) & (to > 0) & (to < len(self.check))
        there &= self.check[np.where(there, to, 0)] == slots
        return np.where(there, to, -1)


def build(
    roots: np.ndarray, lengths: np.ndarray, turns: np.ndarray
) -> tuple[DoubleArray, np.ndarray, np.ndarray]:
    """Double array of sequences, and the dense ids of their roots and turns.

    Sequence k has ``lengths[k]`` of ``turns``, given one sequence after the
    other, below its root. Ids are given as turns are met, level by level, so
    those of siblings lie together.
    """
    trie = DoubleArray()
    known, place = np.unique(turns, return_inverse=True)
    _, root = np.unique(roots, return_inverse=True)
    root = root.ravel()
    next_id = int(root.max()) + 1 if len(root) else 0
    ids = np.full(len(known), -1, np.int64)
    start = np.cumsum(lengths) - lengths
    trie.add(np.zeros(next_id, np.int64), np.arange(next_id))
    here = trie.step(np.zeros(len(root), np.int64), root)
    for depth in range(int(lengths.max()) if len(lengths) else 0):
        alive = np.flatnonzero(lengths > depth)
        at = place[start[alive] + depth]
        pairs = np.unique(np.column_stack([here[alive], at]), axis=0)
        new, first = np.unique(pairs[ids[pairs[:, 1]] < 0, 1], return_index=True)
        ids[new[np.argsort(first)]] = next_id + np.arange(len(new))
        next_id += len(new)
        parents, symbols = pairs[:, 0], ids[pairs[:, 1]]
        order = np.lexsort([symbols, parents])
        trie.add(parents[order], symbols[order])
        here[alive] = trie.step(here[alive], ids[at])
    return trie, root, ids[place]


NODE = (
    "k1 bigint, k2 bigint, p1 bigint, p2 bigint, depth bigint, conv_id bigint, parent bigint,"
    " n bigint, bytes bigint, children bigint, leaves bigint, saved bigint, shared boolean,"
    " above array<struct<k1:bigint,k2:bigint>>"
)
LISTS = ("turns", "k1s", "k2s", "sizes")


def _shard_nodes(table: pa.Table) -> pa.Table:
    """Nodes of one shard's double array.

    A node above the prefix its classes are dealt by is shared: it has the
    children, leaves and sums of what is below in this shard alone, without its
    own. A shared node lists the keys of the nodes above it in the stretch.
    """
    column = {c: table[c].combine_chunks() for c in table.column_names}
    get = {c: column[c].to_numpy(zero_copy_only=False) for c in column if c not in LISTS}
    lengths = get["length"].astype(np.int64)
    turns, k1s, k2s, sizes = (column[c].flatten().to_numpy(zero_copy_only=False) for c in LISTS)
    roots = np.column_stack([get["p1"], get["p2"]])
    first_roots, of_root = np.unique(roots, axis=0, return_inverse=True)
    trie, root, symbols = build(of_root.ravel(), lengths, turns)
    slots = len(trie.check)
    made = {c: np.zeros(slots, np.int64) for c in ("k1", "k2", "depth", "n", "bytes", "children", "leaves", "saved")}
    conv = np.full(slots, np.iinfo(np.int64).max)
    cut = np.zeros(slots, np.int64)
    start = np.cumsum(lengths) - lengths
    band = int(get["band_start"][0])

    # All classes walk the arrays together.
    here = np.zeros(len(lengths), np.int64)
    for depth in range(int(lengths.max()) + 1):
        alive = np.flatnonzero(lengths >= depth)
        at = start[alive] + depth - 1
        here[alive] = to = trie.step(here[alive], root[alive] if depth == 0 else symbols[at])
        if (to < 0).any():
            raise AssertionError("a conversation left the trie it was put into")
        np.add.at(made["n"], to, get["n"][alive])
        np.minimum.at(conv, to, get["rep"][alive])
        np.maximum.at(cut, to, get["cut"][alive])
        made["depth"][to] = depth
        made["k1"][to] = get["p1"][alive] if depth == 0 else k1s[at]
        made["k2"][to] = get["p2"][alive] if depth == 0 else k2s[at]
        if depth:
            made["bytes"][to] = sizes[at]

    nodes = np.unique(np.flatnonzero(made["n"] > 0))
    depth, parent = made["depth"], trie.check
    shared = depth < cut
    inner = nodes[depth[nodes] > 0]
    counted = inner[~shared[inner]]
    np.add.at(made["children"], parent[counted], 1)
    # What the stretch below found for the last turn of a class.
    np.add.at(made["children"], here, get["below_children"])
    np.add.at(made["leaves"], here, get["below_leaves"])
    np.add.at(made["saved"], here, get["below_saved"])
    made["leaves"][counted] += made["children"][counted] == 0
    made["saved"][counted] += (made["n"][counted] - 1) * made["bytes"][counted]
    for level in range(int(depth.max()), 0, -1):
        level_nodes = inner[depth[inner] == level]
        for c in ("leaves", "saved"):
            np.add.at(made[c], parent[level_nodes], made[c][level_nodes])

    def above(slot: int) -> list[dict[str, int]]:
        out = []
        while depth[slot] > 0:
            slot = parent[slot]
            out.append({"k1": int(made["k1"][slot]), "k2": int(made["k2"][slot])})
        return out

    up = parent[nodes]
    known = (depth[nodes] > 0) & ~shared[up] & (depth[up] > 0)
    out = {
        "k1": made["k1"][nodes],
        "k2": made["k2"][nodes],
        "p1": np.where(depth[nodes] > 0, made["k1"][up], 0),
        "p2": np.where(depth[nodes] > 0, made["k2"][up], 0),
        "depth": depth[nodes] + band,
        "conv_id": conv[nodes],
        "parent": pa.array(conv[up], pa.int64(), mask=~known),
        "n": made["n"][nodes],
        "bytes": made["bytes"][nodes],
        "children": made["children"][nodes],
        "leaves": made["leaves"][nodes],
        "saved": made["saved"][nodes],
        "shared": shared[nodes],
        "above": pa.array(
            [above(k) if shared[k] else None for k in nodes],
            pa.list_(pa.struct([("k1", pa.int64()), ("k2", pa.int64())])),
        ),
    }
    return pa.table(out)


def _cut_key(cut: Column) -> Column:
    """Hash of the prefix of a class that is ``cut`` turns long, or all of it."""
    at = F.least(cut, F.col("length")) - 1
    return F.when(F.col("length") == 0, F.xxhash64("p1", "p2")).otherwise(
        F.xxhash64(F.get("k1s", at), F.get("k2s", at))
    )


def _dealt(classes: DataFrame, shard_turns: int) -> DataFrame:
    """Classes of a stretch with ``cut``, turns of the prefix they are dealt by, and ``shard``."""
    total = classes.agg(F.sum("length")).first()[0] or 0
    found = classes.withColumn("cut", F.lit(1)).withColumn("part", _cut_key(F.col("cut")))
    while True:
        sizes = found.groupBy("part").agg(
            F.sum("length").alias("size"), F.max("cut").alias("longest")
        )
        too_much = (F.col("size") > shard_turns) & (F.col("longest") < STRETCH)
        large = store(sizes.where(too_much).select("part"), "large-prefixes")
        if large.isEmpty():
            break
        longer = F.least(F.col("cut") * 2, F.lit(STRETCH))
        found = store(
            found.join(large.withColumn("over", F.lit(True)), "part", "left")
            .withColumn("cut", F.when(F.col("over"), longer).otherwise(F.col("cut")))
            .withColumn("part", _cut_key(F.col("cut")))
            .drop("over"),
            "prefixes",
        )
    shards = max(1, total // shard_turns)
    return found.withColumn("shard", F.pmod("part", F.lit(shards)))


def _stretch_nodes(classes: DataFrame, shard_turns: int) -> DataFrame:
    """Nodes of a stretch, the ones it starts from included, as in NODE without ``above``."""
    columns = [
        "p1", "p2", "length", *LISTS, "n", "rep", "cut", "band_start",
        "below_children", "below_leaves", "below_saved",
    ]
    found = store(
        _dealt(classes, shard_turns)
        .select("shard", *columns)
        .groupBy("shard")
        .applyInArrow(lambda t: _shard_nodes(t.drop_columns("shard")), NODE),
        "shard-nodes",
    )
    merged = store(
        found.where("shared")
        .groupBy("k1", "k2")
        .agg(
            *[F.first(c).alias(c) for c in ("p1", "p2", "depth", "bytes", "above")],
            F.min("conv_id").alias("conv_id"),
            *[F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")],
        ),
        "shared-nodes",
    )
    shared_children = (
        merged.where(F.size("above") > 0)
        .groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2"))
        .agg(F.count(F.lit(1)).alias("more"))
    )
    counted = merged.join(shared_children, ["k1", "k2"], "left").withColumn(
        "children", F.col("children") + F.coalesce("more", F.lit(0))
    )
    # What a shared node adds by itself, to itself and to all above.
    own = counted.select(
        F.explode(F.concat("above", F.array(F.struct("k1", "k2")))).alias("to"),
        (F.col("children") == 0).cast("long").alias("own_leaves"),
        ((F.col("n") - 1) * F.col("bytes")).alias("own_saved"),
    )
    sums = own.groupBy(F.col("to.k1").alias("k1"), F.col("to.k2").alias("k2")).agg(
        F.sum("own_leaves").alias("own_leaves"), F.sum("own_saved").alias("own_saved")
    )
    shared = counted.join(sums, ["k1", "k2"]).select(
        "k1", "k2", "p1", "p2", "depth", "conv_id", F.lit(None).cast("long").alias("parent"),
        "n", "bytes", "children",
        (F.col("leaves") + F.col("own_leaves")).alias("leaves"),
        (F.col("saved") + F.col("own_saved")).alias("saved"),
        F.lit(True).alias("shared"),
    )
    return store(found.where("NOT shared").drop("above").unionByName(shared), "stretch-nodes")


def _numbered(conversations: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Turns in order: conversation, hashes and bytes of the turn, its number from 0, block, place."""

    def text(name: str) -> Column:
        return F.coalesce(F.col(f"`{columns[name]}`").cast("string"), F.lit(""))

    rows = conversations.select(
        F.col(f"`{columns['conv_id']}`").cast("long").alias("conv_id"),
        F.col(f"`{columns['turn']}`").alias("turn"),
        text("role").alias("role"),
        F.xxhash64(text("role"), text("text")).alias("t1"),
        F.xxhash64(F.lit(1), text("text"), text("role")).alias("t2"),
        F.octet_length(text("text")).cast("long").alias("bytes"),
    ).where(F.col("conv_id").isNotNull())
    blocks = ordered_blocks(rows, ["conv_id", "turn", "role"])
    here = W.partitionBy(BLOCK, "conv_id").orderBy(POSITION)
    number = F.row_number().over(here) - 1
    parts = blocks.groupBy(BLOCK, "conv_id").agg(F.count(F.lit(1)).alias("rows"))
    return _carried(
        blocks.drop("turn", "role").withColumn("number", number.cast("long")),
        parts,
        {"number": ("rows", F.sum, lambda here, before: here + before)},
    )


def _carried(rows: DataFrame, parts: DataFrame, sums: dict) -> DataFrame:
    """``rows`` with running values of a conversation carried over from earlier blocks.

    ``sums`` gives by column the part sums it is carried by, their aggregate and
    how the two combine. Only a conversation at the start of a block has rows
    in earlier ones, so what is broadcast has a row per block at most.
    """
    before = W.partitionBy("conv_id").orderBy(BLOCK).rowsBetween(W.unboundedPreceding, -1)
    later = F.row_number().over(W.partitionBy("conv_id").orderBy(BLOCK)) > 1
    carried = parts.select(
        BLOCK, "conv_id", later.alias("_later"),
        *[total(part).over(before).alias(f"_{name}") for name, (part, total, _) in sums.items()],
    ).where("_later")
    joined = rows.join(F.broadcast(carried.drop("_later")), [BLOCK, "conv_id"], "left")
    return joined.withColumns(
        {
            name: combine(F.col(name), F.coalesce(F.col(f"_{name}"), F.lit(0).cast("long")))
            for name, (_, _, combine) in sums.items()
        }
    ).drop(*[f"_{name}" for name in sums])


def _salted(t1: Column, t2: Column, depth: Column) -> tuple[Column, Column]:
    """Two hashes of a turn at a depth."""
    depth = depth.cast("long")
    return F.xxhash64(t1, t2, depth), F.xxhash64(depth, t2, t1, F.lit(1))


def _rebuilt(turns: DataFrame, family: int, most_head: int) -> tuple[DataFrame, DataFrame]:
    """Conversations with their number of turns, and their turns by depth, with keys of nodes.

    A conversation begins with the first turns of the first of its family, in
    place of as many of its own; ``most_head`` of 1 leaves all as they are.
    """
    whole = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("rows"))
    base = F.col("conv_id") - F.col("conv_id") % family
    first_turns = (
        turns.where((F.col("conv_id") == base) & (F.col("number") < most_head - 1))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct("number", "t1", "t2", "bytes"))).alias("first"))
    )
    h = F.crc32(F.col("conv_id").cast("string")) % most_head
    heads = F.coalesce(
        F.slice("first", F.lit(1), F.col("h").cast("int")),
        F.array().cast("array<struct<number:bigint,t1:bigint,t2:bigint,bytes:bigint>>"),
    )

    def key(which: int):
        """The key after each number of head turns, from none on."""

        def one(x: Column, i: Column) -> Column:
            return _salted(x["t1"], x["t2"], i + 1)[which]

        hashes = F.transform("head", one)
        ends = F.sequence(F.lit(0), F.size("head"))
        return F.transform(
            ends,
            lambda d: F.aggregate(
                F.slice(hashes, F.lit(1), d), F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x)
            ),
        )

    convs = store(
        whole.withColumn("h", h)
        .withColumn("base", base)
        .join(first_turns, "base", "left")
        .withColumn("head", heads)
        .withColumn("m", F.size("head").cast("long"))
        .select(
            "conv_id", "h", "m", "head", key(0).alias("keys1"), key(1).alias("keys2"),
            F.aggregate("head", F.lit(0).cast("long"), lambda a, x: a + x["bytes"]).alias("head_bytes"),
            (F.col("m") + F.greatest(F.col("rows") - F.col("h"), F.lit(0))).alias("length"),
        ),
        "conversations",
    )
    depth = F.col("number") - F.col("h") + F.col("m") + 1
    s1, s2 = _salted(F.col("t1"), F.col("t2"), F.col("depth"))
    own = store(
        turns.join(convs, "conv_id")
        .where(F.col("number") >= F.col("h"))
        .withColumn("depth", depth)
        .select(
            BLOCK, POSITION, "conv_id", "depth", "t1", "bytes", s1.alias("s1"), s2.alias("s2"),
            F.get("keys1", F.col("m").cast("int")).alias("h1"),
            F.get("keys2", F.col("m").cast("int")).alias("h2"),
            "head_bytes",
        ),
        "own-turns",
    )
    here = W.partitionBy(BLOCK, "conv_id").orderBy(POSITION).rowsBetween(W.unboundedPreceding, 0)
    running = own.withColumns(
        {
            "k1": F.bit_xor("s1").over(here),
            "k2": F.bit_xor("s2").over(here),
            "upto": F.sum("bytes").over(here),
        }
    )
    parts = own.groupBy(BLOCK, "conv_id").agg(
        F.bit_xor("s1").alias("x1"), F.bit_xor("s2").alias("x2"), F.sum("bytes").alias("size")
    )
    carried = _carried(
        running,
        parts,
        {
            "k1": ("x1", F.bit_xor, lambda a, b: a.bitwiseXOR(b)),
            "k2": ("x2", F.bit_xor, lambda a, b: a.bitwiseXOR(b)),
            "upto": ("size", F.sum, lambda a, b: a + b),
        },
    )
    later = carried.select(
        "conv_id", "depth", "t1", "bytes",
        F.col("k1").bitwiseXOR(F.col("h1")).alias("k1"),
        F.col("k2").bitwiseXOR(F.col("h2")).alias("k2"),
        "s1", "s2",
        (F.col("upto") + F.col("head_bytes")).alias("upto"),
    )
    begin = convs.select(
        "conv_id", "keys1", "keys2", "head", F.posexplode("head").alias("at", "turn")
    )
    upto = F.aggregate(
        F.slice("head", F.lit(1), F.col("at") + 1), F.lit(0).cast("long"), lambda a, x: a + x["bytes"]
    )
    s1, s2 = _salted(F.col("turn.t1"), F.col("turn.t2"), F.col("at") + 1)
    begin = begin.select(
        "conv_id", (F.col("at") + 1).cast("long").alias("depth"), "turn.t1", "turn.bytes",
        F.get("keys1", F.col("at") + 1).alias("k1"), F.get("keys2", F.col("at") + 1).alias("k2"),
        s1.alias("s1"), s2.alias("s2"), upto.alias("upto"),
    )
    rows = later.unionByName(begin).select(
        "conv_id", "depth", "t1", "bytes", "k1", "k2", "upto",
        F.col("k1").bitwiseXOR(F.col("s1")).alias("p1"),
        F.col("k2").bitwiseXOR(F.col("s2")).alias("p2"),
    )
    return convs.select("conv_id", "length"), store(rows, "rebuilt-turns")


def _hashed_ends(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending, comma-joined ids of each end (e1, e2).

    Ids are joined into texts of bounded size where they are sorted; a hash is
    then fed these texts one after the other, so an end of any number of ids
    needs the memory of one batch.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        out: list[tuple] = []
        for batch in batches:
            for e1, e2, i in zip(*(batch[c].to_pylist() for c in ("e1", "e2", "conv_id"))):
                if held and (held[0], held[1]) == (e1, e2) and held[4] < CHUNK:
                    held[3].append(str(i))
                    held[4] += len(held[3][-1]) + 1
                    continue
                if held:
                    out.append((held[0], held[1], held[2], ",".join(held[3])))
                held = [e1, e2, i, [str(i)], 0]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["e1", "e2", "first", "ids"])
                out = []
        if held:
            out.append((held[0], held[1], held[2], ",".join(held[3])))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["e1", "e2", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        out: list[tuple] = []
        for batch in batches:
            for e1, e2, ids in zip(*(batch[c].to_pylist() for c in ("e1", "e2", "ids"))):
                if key == (e1, e2):
                    state.update(b"," + ids.encode())
                    continue
                if key:
                    out.append((*key, state.hexdigest()))
                key, state = (e1, e2), hashlib.sha256(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["e1", "e2", "sha"])
                out = []
        if key:
            yield pa.RecordBatch.from_arrays(
                [pa.array([v]) for v in (*key, state.hexdigest())], ["e1", "e2", "sha"]
            )

    joined = (
        ends.repartitionByRange("e1", "e2", "conv_id")
        .sortWithinPartitions("e1", "e2", "conv_id")
        .mapInArrow(join, "e1 bigint, e2 bigint, first bigint, ids string")
    )
    return (
        joined.repartition("e1", "e2")
        .sortWithinPartitions("e1", "e2", "first")
        .mapInArrow(digest, "e1 bigint, e2 bigint, sha string")
    )


def prefix_trie(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    family: int = FAMILY,
    most_head: int = MOST_HEAD,
    stretch: int = STRETCH,
    shard_turns: int = SHARD_TURNS,
) -> DataFrame:
    """A row per node of the trie of conversations, as they are rebuilt.

    A conversation begins with the first turns of the first of its ``family``,
    CRC of its id modulo ``most_head`` of them (1 leaves all as they are), and
    goes on with its own turns after as many. ``conv_id`` is the least member,
    ``n_children``, ``n_leaves`` and ``saved_tokens`` (bytes of last texts, for
    each member but one) belong to the subtree, ``ends_sha256`` to the ids of
    members without further turns.

    Turns are ordered by ``turn``, NULL first, then role, then a hash of the
    text; equal rows are turns of their own. NULL role or text is empty. Rows
    without id belong to no conversation. Other columns are ignored. No
    conversations have no nodes, not even a root.
    """
    columns = {"conv_id": conv_id, "turn": turn, "role": role, "text": text}
    turns = store(_numbered(conversations, columns), "numbered-turns")
    convs, rows = _rebuilt(turns, family, most_head)
    last = rows.groupBy("conv_id").agg(
        F.max_by(F.struct("k1", "k2", "upto"), "depth").alias("last")
    )
    zero = F.lit(0).cast("long")
    ends = store(
        convs.join(last, "conv_id", "left").select(
            "conv_id", "length",
            F.coalesce("last.k1", zero).alias("e1"),
            F.coalesce("last.k2", zero).alias("e2"),
            F.coalesce("last.upto", zero).alias("total"),
        ),
        "ends",
    )
    classes = store(
        ends.groupBy("e1", "e2").agg(
            F.min("conv_id").alias("rep"),
            F.count(F.lit(1)).alias("n"),
            F.first("length").alias("whole"),
            F.first("total").alias("total"),
        ),
        "classes",
    )
    deepest, root = classes.agg(F.max("whole"), F.min("rep")).first()
    band = F.floor((F.col("depth") - 1) / stretch)
    own = rows.join(
        classes.select(F.col("rep").alias("conv_id"), "n", "whole", "total"), "conv_id"
    ).withColumn("band", band)
    nodes: list[DataFrame] = []
    below = tails = None
    shared_bands = 1
    if (deepest or 0) > stretch:
        own = store(own, "class-turns")
        starts = own.where((F.col("depth") % stretch == 1) & (F.col("band") > 0))
        if stretch == 1:
            starts = own.where(F.col("band") > 0)
        alone = (
            starts.groupBy("band", "p1", "p2")
            .agg(F.count(F.lit(1)).alias("classes"), F.min("conv_id").alias("conv_id"))
            .where("classes = 1")
            .groupBy("conv_id")
            .agg(F.min("band").alias("tail"))
        )
        own = store(own.join(alone, "conv_id", "left"), "marked-turns")
        in_tail = F.coalesce(F.col("band") >= F.col("tail"), F.lit(False))
        tails = own.where(in_tail)
        own = own.where(~in_tail)
        shared_bands = own.agg(F.max("band")).first()[0] + 1
        first_of_tail = F.col("depth") == F.col("tail") * stretch + 1
        left = F.col("total") - F.col("upto") + F.col("bytes")
        nodes.append(
            tails.select(
                "k1", "k2", "p1", "p2", "depth", "conv_id",
                F.when(~first_of_tail, F.col("conv_id")).alias("parent"),
                "n", "bytes",
                (F.col("depth") < F.col("whole")).cast("long").alias("children"),
                F.lit(1).cast("long").alias("leaves"),
                ((F.col("n") - 1) * left).alias("saved"),
                F.lit(False).alias("shared"),
            )
        )
        below = tails.where(first_of_tail).select(
            (F.col("tail") - 1).alias("of"), F.col("p1").alias("k1"), F.col("p2").alias("k2"),
            F.lit(1).cast("long").alias("children"), F.lit(1).cast("long").alias("leaves"),
            ((F.col("n") - 1) * left).alias("saved"),
        )
    turn_fields = F.sort_array(F.collect_list(F.struct("depth", "t1", "k1", "k2", "bytes")))
    segments = own.groupBy("conv_id", "band").agg(
        turn_fields.alias("s"),
        F.first("n").alias("n"),
        F.min_by(F.struct("p1", "p2"), "depth").alias("p"),
        F.max_by(F.struct("k1", "k2"), "depth").alias("e"),
    )
    segments = segments.groupBy("band", "e.k1", "e.k2").agg(
        F.min("conv_id").alias("rep"), F.sum("n").alias("n"),
        F.first("s").alias("s"), F.first("p").alias("p"),
    ).select(
        "band", "k1", "k2", "rep", "n", "p.p1", "p.p2", F.size("s").alias("length"),
        F.col("s.t1").alias("turns"), F.col("s.k1").alias("k1s"),
        F.col("s.k2").alias("k2s"), F.col("s.bytes").alias("sizes"),
    )
    none = F.array().cast("array<bigint>")
    turnless = classes.where("whole = 0").select(
        zero.alias("band"), zero.alias("k1"), zero.alias("k2"), "rep", "n",
        zero.alias("p1"), zero.alias("p2"), F.lit(0).alias("length"),
        *[none.alias(c) for c in LISTS],
    )
    segments = store(segments.unionByName(turnless), "stretches")
    for k in range(shared_bands - 1, -1, -1):
        here = segments.where(F.col("band") == k)
        if below is None:
            found = here.withColumns({f"below_{c}": zero for c in ("children", "leaves", "saved")})
        else:
            deeper = below.where(F.col("of") == k).select(
                "k1", "k2", *[F.col(c).alias(f"below_{c}") for c in ("children", "leaves", "saved")]
            )
            found = here.join(deeper, ["k1", "k2"], "left").fillna(
                0, [f"below_{c}" for c in ("children", "leaves", "saved")]
            )
        found = _stretch_nodes(
            found.withColumn("band_start", F.lit(k * stretch).cast("long")), shard_turns
        )
        nodes.append(found if k == 0 else found.where(F.col("depth") > k * stretch))
        if k:
            top = found.where(F.col("depth") == k * stretch).select(
                F.lit(k - 1).alias("of"), "k1", "k2", "children", "leaves", "saved"
            )
            below = top if below is None else below.unionByName(top)
    every = nodes[0]
    for more in nodes[1:]:
        every = every.unionByName(more)
    every = store(every, "nodes")
    parents = every.where(F.col("shared") | (F.col("depth") % stretch == 0)).select(
        F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("found")
    )
    parent = F.when(F.col("depth") == 1, F.lit(root)).when(
        F.col("depth") > 1, F.coalesce("parent", "found")
    )
    direct = F.col("parent").isNotNull() | (F.col("depth") < 2)
    named = every.where(direct).withColumn("found", F.lit(None).cast("long")).unionByName(
        every.where(~direct).join(parents, ["p1", "p2"], "left")
    )
    digests = _hashed_ends(ends.select("e1", "e2", "conv_id"))
    return named.join(
        digests, (F.col("k1") == F.col("e1")) & (F.col("k2") == F.col("e2")), "left"
    ).select(
        "conv_id",
        "depth",
        parent.cast("long").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("sha", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
