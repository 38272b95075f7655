"""Fingerprints, shards, rules and lines: built-in functions only."""

import hashlib
import time
import zlib
from collections import Counter

import pytest
from compare import connect, difference
from fixtures import awkward, awkward_rows, edited, empty, prose, words_of
from helpers import plan_of
from pyspark.sql import functions as F

from merchantry.llm import clusters, lines, queries, ring, rules, syncmers

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    "name",
    ["op1_syncmer_fingerprints", "op2_ring_shards", "op6_quality_rules", "op7_line_dedup"],
)
def test_no_python_in_the_plan(spark, name):
    plan = plan_of(queries.QUERIES[name](spark, FOLDER))
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian"))


@pytest.mark.parametrize("name", list(queries.SQL))
def test_queries_with_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, FOLDER), connect(FOLDER), queries.SQL[name]) == ""


def test_edits_and_their_digests(spark):
    rows = [(3, "abcdef"), (1, None), (2, "xy"), (7, "ö" * 5)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("number", F.lit(1))
    found = {r["doc_id"]: r for r in syncmers.fingerprint_edits(df).collect()}
    order = [(i, t or "") for i, t in sorted(rows, reverse=True)]
    for k, (i, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        new = text[: len(text) - half] + after[:half]
        assert found[i]["n_chars"] == len(text)
        assert found[i]["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()


def test_fingerprints_follow_the_text(spark):
    base = prose(3, 900)
    rows = [(1, base), (2, base), (3, edited(base, 300)), (4, prose(4, 900)), (5, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = dict(syncmers.with_fingerprint(df, "text", "f").select("doc_id", "f").collect())
    assert found[1] == found[2] and len(found[1]) == syncmers.KEPT and len(found[5]) == 1
    pairs = spark.createDataFrame([(found[1], found[k]) for k in (2, 3, 4)], "a array<int>, b array<int>")
    same, near, far = (r[0] for r in pairs.select(syncmers.likeness(F.col("a"), F.col("b"))).collect())
    assert same == 1.0 and near > 0.8 and far < 0.1


def test_anchors_are_closed_syncmers_and_do_not_depend_on_their_place(spark):
    text = prose(5, 80)
    df = spark.createDataFrame([(1, text), (2, "some words before " + text)], "doc_id bigint, text string")
    found = syncmers.anchors(df).collect()
    at = {d: {(r["place"], r["hash"]) for r in found if r["doc_id"] == d} for d in (1, 2)}
    assert {(p + 3, h) for p, h in at[1]} <= at[2]
    assert 0.3 < len(at[1]) / (len(text.split()) - syncmers.K + 1) < 0.7


def test_fingerprints_of_awkward_rows(spark):
    df = awkward(spark, "fingerprint", "number", "key_id")
    found = syncmers.fingerprint_edits(df).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r[0] for r in awkward_rows())
    assert syncmers.fingerprint_edits(empty(spark)).count() == 0


def test_short_texts_have_fingerprints_of_their_own(spark):
    rows = [(100 * n + k, " ".join(f"w{n}x{k}x{j}" for j in range(n))) for n in range(1, 9) for k in range(40)]
    df = spark.createDataFrame([*rows, (0, "")], "doc_id bigint, text string")
    found = {r["doc_id"]: tuple(r["fingerprint"]) for r in syncmers.fingerprint_edits(df).collect()}
    assert found.pop(0) == () and all(found.values()) and len(set(found.values())) == len(rows)
    assert {r["doc_id"] for r in syncmers.anchors(df).collect()} == set(found)


def test_shards(spark):
    rows = awkward_rows()
    found = ring.shard_documents(awkward(spark, "shard", "slot", "size"), 4).collect()
    expected = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert Counter(tuple(r)[:3] for r in found) == expected
    sizes = Counter(r["shard"] for r in found)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for shard, size in sizes.items():
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(size))
    assert ring.shard_documents(empty(spark)).count() == 0


def flow_by_rows(counts, owners, room):
    """The same flow, one row at a time."""
    room, where, over = list(room), {}, []
    for place, count in enumerate(counts):
        for rank in range(count):
            if room[owners[place]]:
                room[owners[place]] -= 1
                where[place, rank] = owners[place]
            else:
                over.append((place, rank))
    waiting = []
    for step in range(2 * len(counts)):
        here = step % len(counts)
        if step < len(counts):
            waiting += [x for x in over if x[0] == here]
        while waiting and room[owners[here]]:
            room[owners[here]] -= 1
            where[waiting.pop(0)] = owners[here]
    return where


def test_flow_with_a_hot_place():
    counts = [(7 * k) % 5 for k in range(64)]
    counts[10] = 90  # a third of all rows
    owners = ring.ring_owners(5, 8, 64)
    room = ring.capacities(sum(counts), 5, 0)
    plan = ring.bounded_flow(counts, owners, room)
    found = {(p, r): s for p, a, b, s, _ in plan for r in range(a, b)}
    assert found == flow_by_rows(counts, owners, room)


def test_slack_limits_movement(spark):
    rows = spark.range(4000).withColumnRenamed("id", "doc_id")
    before = dict(ring.assign_shards(rows, ["doc_id"], 16, 0.25).select("doc_id", "shard").collect())
    after = dict(ring.assign_shards(rows, ["doc_id"], 17, 0.25).select("doc_id", "shard").collect())
    assert max(Counter(before.values()).values()) <= -(-4000 * 1.25 // 16)
    assert sum(before[i] != after[i] for i in before) < 4000 * 0.25


def repeat_words(text):
    words = [w.decode() for w in (text or "").encode().split()]
    seen = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    return len({k + j for k in range(len(words) - 2) if seen[tuple(words[k : k + 3])] > 1 for j in range(3)})


def test_rules_on_awkward_rows(spark):
    found = rules.judge_documents(awkward(spark, "alive", "words", "n_lines")).collect()
    assert len(found) == len(awkward_rows())
    by_id = {r["doc_id"]: r for r in found}
    for i, text, *_ in awkward_rows():
        assert by_id[i]["n_words"] == len(words_of(text))
        assert by_id[i]["n_repeat_words"] == repeat_words(text)
    assert by_id[29]["base_failed"] and by_id[29]["n_dup_lines"] == 39
    assert by_id[0]["kept"] and not by_id[23]["kept"]
    assert rules.judge_documents(empty(spark)).count() == 0


def test_the_filter_keeps_what_the_verdict_keeps(spark):
    docs = awkward(spark, "n_words")
    kept = rules.keep_documents(docs)
    assert kept.columns == docs.columns
    verdict = rules.judge_documents(docs).where("kept").select("doc_id").collect()
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in verdict)
    assert rules.keep_documents(empty(spark)).count() == 0


def test_a_condition_on_the_verdict_of_a_long_text(spark):
    docs = spark.createDataFrame([(1, prose(11, 20_000)), (2, "short")], "doc_id bigint, text string")
    start = time.time()
    assert [r["doc_id"] for r in rules.judge_documents(docs).where("kept AND n_words > 10").collect()] == [1]
    assert time.time() - start < 30


def test_rules_are_ordered_by_rejections_per_cost(spark):
    rows = spark.createDataFrame([("a b " * 40,)] * 30 + [("# " * 80,)] * 30, "text string")
    never = rules.Rule("never", ("n_repeat_words",), lambda n: n < 0)
    often = rules.Rule("often", ("n_symbols",), lambda n: n > 10)
    assert [r.name for r in rules.order_rules(rows, [never, often])] == ["often", "never"]


def test_fuzzy_lines(spark):
    line = "Contact number 12 for all further questions about this most particular matter"
    rows = [
        (1, f"{line}\nshort one\nAn own line of this document that nobody else has"),
        (2, f"{line.upper().replace('12', '34')}!!\nSHORT one\n\n"),
        (3, line.replace("further", "furthre") + "\nQuite another thing is said in this other line"),
        (4, None),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("lines", F.lit(0))
    found = {r["doc_id"]: r for r in lines.without_repeats(df).collect()}
    assert found[1]["dropped_lines"] == 0 and found[1]["text"] == rows[0][1]
    assert found[2]["text"] == "\n" and (found[2]["n_lines"], found[2]["dropped_lines"]) == (4, 2)
    assert found[3]["text"] == "Quite another thing is said in this other line"
    assert found[4]["text"] is None and found[4]["n_lines"] == 0


def word_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_lines_are_alike_by_a_tenth_of_their_words(spark):
    import random

    r = random.Random(2)
    rows = []
    for n in (1, 3, 4, 5, 14, 15, 24, 25, 60, 400):
        for _ in range(8):
            a = [r.choice("abcdefghijklmnop") * 3 for _ in range(n)]
            b = list(a)
            for _ in range(r.randint(0, n // 8 + 1)):
                k = r.randrange(len(b) + 1)
                b[k : k + r.randint(0, 1)] = ["new"] * r.randint(0, 1)
            if b:
                rows.append((" ".join(a), " ".join(b)))
    df = spark.createDataFrame(rows, "a string, b string")
    for a, b, found in df.select("a", "b", lines.alike(F.col("a"), F.col("b"))).collect():
        x, y = a.split(), b.split()
        assert found == (word_distance(x, y) <= (max(len(x), len(y)) + 5) // 10), (a, b)


def test_lines_of_awkward_rows(spark):
    docs = awkward(spark, "dropped", "text_hash", "line_no", "n_lines", "dropped_lines")
    found = lines.without_repeats(docs)
    assert found.columns == [*[c for c in docs.columns if c not in ("n_lines", "dropped_lines")], "n_lines", "dropped_lines"]
    rows = {r["doc_id"]: r for r in found.collect()}
    assert found.count() == len(awkward_rows())
    assert rows[21]["text"] == "" and rows[20]["dropped_lines"] == 0
    assert rows[29]["dropped_lines"] == 39 and rows[23]["text"] is None
    kept = lines.deduplicated(docs)
    assert kept.columns == docs.columns and 21 not in {r["doc_id"] for r in kept.collect()}
    assert {r["n_lines"] for r in kept.collect()} == {"mine"}
    assert lines.deduplicated(empty(spark)).count() == 0


def test_simhash_blocks(spark):
    import random

    r = random.Random(1)
    rows = [([r.getrandbits(64) - 2**63 for _ in range(5)],) for _ in range(50)] + [([7, 7, 7, 7, 7],), ([7, 7, 7, 7, 8],)]
    df = spark.createDataFrame(rows, "h array<bigint>")
    made = df.selectExpr("h", *[f"h[{k}]" for k in range(5)]).select(lines.simhash(F.col("h")), *[
        F.xxhash64(F.col("`h[0]`"), F.col("`h[1]`")), F.xxhash64(F.col("`h[3]`"), F.col("`h[4]`"), F.lit(3)),
        F.xxhash64(F.col("`h[2]`"), F.lit(2)),
    ]).collect()
    assert len({r[0] for r in made}) == len(rows)
    for found, *votes in made:
        bits = sum(1 << k for k in range(64) if sum((v >> k) & 1 for v in votes) > 1)
        assert found % (1 << 64) == bits


def test_lengths_and_parities_rule_out_unlike_lines_only(spark):
    """All lines of one bucket: pairs made are few, and every pair that is alike is among them."""
    made = pairs_of_lines([("replaced", 1), ("put in", 2), ("left out", 3), ("put in", 9)], (6, 12, 30, 90), 8)
    text = [t for _, a, b in made for t in (a, b)]
    hashes = F.transform(F.split("line", " "), lambda w: F.xxhash64(w))
    rows = (
        spark.createDataFrame(list(enumerate(text)), "id bigint, line string")
        .withColumn("hashes", hashes)
        .select("id", F.lit(1).alias("key"), F.col("id").alias("component"), F.size("hashes").alias("n"),
                "hashes", *lines.parities(F.col("hashes")))
    )
    for row in rows.collect():
        turned = [0, 0]
        for h in row["hashes"]:
            turned[h < 0] ^= 1 << (h & 63)
        assert [row["lo"] % (1 << 64), row["hi"] % (1 << 64)] == turned
    found = [(r["a"], r["b"]) for r in lines.near_pairs(rows.drop("hashes")).collect()]
    words = [t.split() for t in text]
    wanted = {
        (y, x) for y in range(len(words)) for x in range(y)
        if abs(len(words[x]) - len(words[y])) <= 10
        and word_distance(words[x], words[y]) <= (max(len(words[x]), len(words[y])) + 5) // 10
    }
    assert len(found) == len(set(found)) and wanted <= set(found)
    assert len(wanted) > 60 and len(found) < 2 * len(wanted)


@pytest.mark.parametrize("chunk", [3, 512])
def test_a_pair_is_a_row_once_and_only_if_alike(spark, monkeypatch, chunk):
    """Lines that share several buckets, most of them a little unlike."""
    monkeypatch.setattr(lines, "CHUNK", chunk)
    base = [f"w{k}" for k in range(40)]
    text = [" ".join(f"x{k}" if p in (3 * k % 40, 5 * k % 40, 7 * k % 40, 9 * k % 40) else w for p, w in enumerate(base)) for k in range(30)]
    text += [text[k] + " more" for k in range(0, 30, 5)]
    keys = [(key, i) for i in range(len(text)) for key in (1, 2, 3) if key < 3 or i % 2]
    mixed = spark.createDataFrame(keys, "key bigint, id bigint").withColumn("component", F.col("id"))
    rows = (
        spark.createDataFrame(list(enumerate(text)), "id bigint, line string")
        .withColumn("hashes", lines.word_hashes(F.col("line")))
        .select("id", F.size("hashes").alias("n"), *lines.parities(F.col("hashes")), lines.characters(F.col("hashes")).alias("line"))
    )
    several = lines.distinct_buckets(mixed)
    assert {(r["key"], r["ids"]) for r in several.collect()} == {(1, len(text)), (3, len(text) // 2)}
    found = [(r["a"], r["b"]) for r in lines.near_pairs(several.join(rows, "id")).collect()]
    words = [t.split() for t in text]
    alike = {
        (x, y) for x in range(len(text)) for y in range(x)
        if word_distance(words[x], words[y]) <= (max(len(words[x]), len(words[y])) + 5) // 10
    }
    assert len(found) == len(alike) and set(found) == alike and 5 < len(alike) < 300


def pairs_of_lines(kinds, sizes, each, seed=4):
    """Lines and edited copies: n words replaced, put in or left out, or characters replaced."""
    import random

    r = random.Random(seed)
    stems = ["".join(r.choices("abcdefghij", k=r.randint(3, 9))) for _ in range(3000)]
    out = []
    for size in sizes:
        for kind, amount in kinds:
            for _ in range(each):
                words = [r.choice(stems) for _ in range(size)]
                text = " ".join(words)
                if kind == "characters":
                    other = list(text)
                    for k in r.sample(range(len(text)), max(1, round(amount * len(text)))):
                        other[k] = r.choice("klmnopqrs")
                    other = "".join(other)
                else:
                    other = list(words)
                    for k in sorted(r.sample(range(size), min(amount, size)), reverse=True):
                        new = r.choice(["replaced", kind]) if kind != "replaced" else kind
                        other[k : k + (new != "put in")] = [] if new == "left out" else [f"x{r.random()}"[2:9]]
                    other = " ".join(other)
                out.append(((size, kind, amount), text, other))
    return out


def test_recall_of_fuzzy_lines_against_all_pairs(spark):
    kinds = [("characters", x) for x in (0.02, 0.04, 0.06, 0.09)]
    kinds += [(k, n) for k in ("replaced", "put in", "left out") for n in (1, 2, 3)]
    made = pairs_of_lines(kinds, (4, 6, 8, 12, 20, 28, 45, 120), 20)
    text = [t for _, a, b in made for t in (a, b)]
    docs = spark.createDataFrame(list(enumerate(text)), "doc_id bigint, text string").repartition(8)
    found = {x["doc_id"] for x in lines.repeated_lines(docs).collect()}
    cells = {}
    for k, (cell, a, b) in enumerate(made):
        x, y = a.split(), b.split()
        wanted = word_distance(x, y) <= (max(len(x), len(y)) + 5) // 10
        assert wanted or 2 * k + 1 not in found
        if wanted:
            cells.setdefault(cell, []).append(2 * k + 1 in found)
    assert not any(2 * k in found for k in range(len(made)))
    recall = {cell: sum(x) / len(x) for cell, x in cells.items()}
    assert sum(map(len, cells.values())) > 400
    assert min(recall.values()) >= 0.9, sorted(recall.items(), key=lambda x: x[1])[:6]


def test_filter_lets_pass_all_that_is_wanted_and_copies_no_bitmaps(spark):
    """Hashes at both ends of a word of the filter, of a bitmap and of the filter itself."""
    places = [0, 1, 7, 8, 55, 56, 63, 64, 32767, 32768, clusters.FILTER_BITS - 1, -1, -64]
    wanted = spark.createDataFrame([(x,) for x in places], "h long")
    rows = spark.createDataFrame([(x,) for x in {*places, *(x + 2 for x in places), *(x - 9 for x in places)}] + [(None,)], "h long")
    likely, rest = clusters.parted(rows, "h", wanted, "h")
    bits = {x % clusters.FILTER_BITS for x in places}
    found = {r["h"] for r in rows.collect() if r["h"] is not None and r["h"] % clusters.FILTER_BITS in bits}
    assert {r["h"] for r in likely.collect()} == found
    assert {r["h"] for r in rest.collect()} == {r["h"] for r in rows.collect()} - found
    plan = likely._jdf.queryExecution().optimizedPlan().toString()
    assert "conv(" not in plan and "substring(" not in plan
