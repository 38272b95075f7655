"""Shards on a consistent-hash ring with virtual nodes and bounded loads.

The ring is cut into places. A key hashes to a place; the first virtual node
from there clockwise names its shard. A shard that is full passes further keys
on clockwise, to the next virtual node of a shard with room. How many rows each
place has is all that is needed to say which ranks at a place stay and which
move on, so the flow is worked out on a table of one row per place, whatever
the number of rows, and rows are then told their shard by place and rank.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import surrogate_key
from .common import values

PLACES = 4096
VIRTUAL_NODES = 64


def ring_owners(shards: int, virtual_nodes: int, places: int) -> list[int]:
    """Shard of each place: that of the first virtual node at or after it, around the ring."""
    nodes: dict[int, int] = {}
    for shard in range(shards):
        for node in range(virtual_nodes):
            digest = hashlib.md5(f"{shard}/{node}".encode()).digest()
            place = int.from_bytes(digest[:8], "big") % places
            nodes[place] = min(shard, nodes.get(place, shard))
    owners, owner = [0] * places, nodes[min(nodes)]
    for place in range(places - 1, -1, -1):
        owner = nodes.get(place, owner)
        owners[place] = owner
    return owners


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """Rows each shard may hold: at most one apart without slack."""
    if slack:
        return [-int(-(1 + slack) * rows // shards)] * shards
    return [rows // shards + (shard < rows % shards) for shard in range(shards)]


def bounded_flow(
    counts: Sequence[int], owners: Sequence[int], room: Sequence[int]
) -> list[tuple[int, int, int, int, int]]:
    """Where the rows of each place go: (place, first rank, end rank, shard, slots before).

    Keys at a shard's own places come first, in ring order; what overflows goes
    on clockwise, first come first served.
    """
    places, room = len(counts), list(room)
    used = [0] * len(room)
    plan, over = [], {}

    def put(place: int, first: int, end: int, shard: int) -> int:
        """Give a shard what it has room for; where the rest begins."""
        end = min(end, first + room[shard])
        if end > first:
            plan.append((place, first, end, shard, used[shard]))
            used[shard] += end - first
            room[shard] -= end - first
        return end

    for place, count in enumerate(counts):
        done = put(place, 0, count, owners[place])
        if done < count:
            over[place] = (place, done, count)
    carried: deque[tuple[int, int, int]] = deque()
    for step in range(2 * places):
        here = step % places
        if step < places and here in over:
            carried.append(over[here])
        while carried and room[owners[here]]:
            place, first, end = carried.popleft()
            done = put(place, first, end, owners[here])
            if done < end:
                carried.appendleft((place, done, end))
    assert not carried, "the shards have too little room"
    return plan


def assign_shards(
    rows: DataFrame,
    key: Sequence[str],
    shards: int,
    slack: float = 0.0,
    virtual_nodes: int = VIRTUAL_NODES,
    places: int = PLACES,
) -> DataFrame:
    """``rows`` with ``shard`` and a gapless ``slot`` from 0 in it.

    Without slack row counts of shards are at most one apart; with it no shard
    holds over ``1 + slack`` times the mean, and fewer rows move when shards
    are added. Rows of one key share a place, so a key with a third of all rows
    fills its shard and runs on clockwise. Ranks at a place follow the columns
    of ``rows``, so the result is a function of the rows; rows equal in all of
    them are exchangeable. NULL keys hash as well; no rows give no rows. The
    columns ``shard`` and ``slot`` must be free.
    """
    placed = rows.withColumn("_ring_place", F.pmod(F.xxhash64(*key), F.lit(places)))
    numbered = surrogate_key(placed, ["_ring_place"], "_ring_number")
    found = {r["_ring_place"]: r["count"] for r in numbered.groupBy("_ring_place").count().collect()}
    counts = [found.get(place, 0) for place in range(places)]
    flow = bounded_flow(
        counts, ring_owners(shards, virtual_nodes, places), capacities(sum(counts), shards, slack)
    )
    starts, before = [], 0
    for count in counts:
        starts.append(before)
        before += count
    # As numbers of the whole order, which begins at 1; a row or a few per place.
    plan = values(
        rows,
        "ring_place, first_number, end_number, to_shard, slots_before",
        [(p, starts[p] + a + 1, starts[p] + b + 1, s, u) for p, a, b, s, u in flow],
    )
    number = F.col("_ring_number")
    return numbered.join(
        F.broadcast(plan),
        (F.col("_ring_place") == F.col("ring_place"))
        & (number >= F.col("first_number"))
        & (number < F.col("end_number")),
    ).select(
        *rows.columns,
        F.col("to_shard").cast("int").alias("shard"),
        (F.col("slots_before") + number - F.col("first_number")).alias("slot"),
    )


def shard_documents(
    docs: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text", slack: float = 0.0
) -> DataFrame:
    """Size, checksum, shard and slot of every document, by the ring on its id.

    A NULL text counts as empty. Repeated rows each get a slot of their own.
    """
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        (F.octet_length(content) + F.lit(1).cast("long")).alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
    )
    return assign_shards(rows, ["doc_id"], shards, slack)
