"""Documents with every awkward case, and brute-force answers."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    stems = ["the", "of", "and"] + ["".join(r.choices("abcdefghij", k=r.randint(3, 9))) for _ in range(400)]
    text = " ".join(r.choice(stems) for _ in range(words))
    pieces = text.split(" ")
    return "\n".join(" ".join(pieces[k : k + 12]) for k in range(0, len(pieces), 12))


def edited(text: str, every: int, mark: str = "changed") -> str:
    words = text.split(" ")
    return " ".join(mark if k % every == every - 1 else w for k, w in enumerate(words))


def awkward_rows() -> list[tuple]:
    base = prose(1, 120)
    rows = [(k, prose(100 + k, 60 + k), "en", f"s{k % 3}", 1) for k in range(12)]
    rows += [
        (20, base, "en", "s0", 1),
        (21, base, "en", "s0", 1),  # a copy
        (22, edited(base, 60), "en", None, None),  # a near copy
        (23, None, None, None, None),
        (24, "", "en", "s1", 0),
        (25, " \n\t ", "en", "s1", 4),
        (26, "one two", "en", "s1", 7),
        (None, prose(7, 70), "en", "s2", 1),
        (27, prose(9, 4000), "en", "s2", 1),  # long
        (28, "ü日本語 x " * 30, "ja", "ü", 1),
        (29, "same line of seven words right here\n" * 40, "en", "s1", 1),
    ]
    return [*rows, (5, *rows[5][1:]), (5, *rows[5][1:])]  # repeated rows


def awkward(spark, *extra: str):
    """The rows, with extra columns of clashing names."""
    df = spark.createDataFrame(awkward_rows(), SCHEMA)
    for name in extra:
        df = df.withColumn(name, F.lit("mine"))
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text: str | None) -> list[str]:
    return [w.decode() for w in (text or "").encode().lower().split()]


def shingle_set(text: str | None) -> frozenset:
    words = words_of(text)
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def near_groups(rows: list[tuple[int, str | None]]) -> dict[int, int]:
    """Least id reachable by similar sets, by comparing all pairs."""
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}
