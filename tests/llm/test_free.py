"""Pieces, archives, language model, mixing, near-duplicates, pages, pipeline."""

import itertools
import math
import random
import re
import time
import zlib
from collections import Counter
from pathlib import Path

import corpus_pipeline
import numpy as np
import pandas as pd
import pytest
from fixtures import awkward, awkward_rows, edited, empty, near_groups, prose, shingle_set
from pyspark.sql import functions as F

from merchantry.llm import clusters, html, lm, minhash, mixing, pieces, warc
from merchantry.session import workspace

FOLDER = "/root/testdata/sf0.001"


def small_vocabulary(r):
    ids, scores, names = {}, [], []
    for n in (1, 2, 3):
        for letters in itertools.product("ab", repeat=n):
            for before in ("", "▁"):
                word = before + "".join(letters)
                if n == 1 and not before or r.random() < 0.6:
                    ids[word] = len(names)
                    names.append(word)
                    scores.append(-float(r.randrange(1, 6)))
    ids["▁"] = len(names)
    return pieces.Vocabulary(ids, [*scores, -3.0], [*names, "▁"])


def all_segmentations(text, vocab):
    if not text:
        return [(0.0, ())]
    return [
        (vocab.scores[vocab.ids[text[:k]]] + s, (vocab.ids[text[:k]], *rest))
        for k in range(1, len(text) + 1)
        if text[:k] in vocab.ids
        for s, rest in all_segmentations(text[k:], vocab)
    ]


def test_n_best_against_all_segmentations():
    r = random.Random(3)
    vocab = small_vocabulary(r)
    for _ in range(150):
        text = "".join(r.choice("ab ") for _ in range(r.randrange(1, 10)))
        encoder = pieces.Encoder(vocab, 5)
        found = encoder.text(encoder.units(text))
        best = sorted((s for s, _ in all_segmentations("▁" + text.replace(" ", "▁"), vocab)), reverse=True)
        assert [round(s, 9) for s, _, _ in found] == [round(s, 9) for s in best[:5]]
        ids = []
        for _, _, changes in found:
            ids.append(list(found[0][1]))
            for c in reversed(changes):
                ids[-1][c.start : c.start + c.removed] = c.ids
        ids = [tuple(x) for x in ids]
        assert len(set(ids)) == len(ids) and {pieces.decode(i, vocab) for i in ids} == {text}


def test_many_words_at_once_are_searched_like_each_alone():
    r = random.Random(6)
    for vocab in (small_vocabulary(r), pieces.vocabulary(pieces.MODEL)):
        letters = "abc" if len(vocab.ids) < 100 else "aeinrst\u00fc\u65e5\U0001f642\u0378x9"
        words = ["\u2581" * r.randrange(3) + "".join(r.choice(letters) for _ in range(r.randrange(1, 30))) for _ in range(800)]
        assert pieces.best_of_words(words, vocab) == [pieces.best_and_loss(w, vocab) for w in words]
    assert pieces.best_of_words([], vocab) == []


def test_a_model_with_pieces_beyond_a_word_is_refused():
    with pytest.raises(ValueError, match="beyond a word"):
        pieces.Vocabulary({"a\u2581b": 0}, [-1.0], ["a\u2581b"])


def test_all_segmentations_come_back_from_the_table(spark):
    vocab = pieces.vocabulary(pieces.MODEL)
    docs = awkward(spark, "ids", "_ids", "round_trip").where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    rows = pieces.encode(docs).withColumn("all", pieces.segmentations(F.col("ids"), F.col("changes"))).collect()
    texts = {i: t or "" for i, t, *_ in awkward_rows()}
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in docs.collect()}
    for r in rows:
        text, found = texts[r["doc_id"]], [list(x) for x in r["all"]]
        assert found[0] == r["ids"] and [len(x) for x in found] == r["n_pieces"]
        assert {pieces.decode(x, vocab) for x in found} == {text} and len({*map(tuple, found)}) == len(found)
        if len(text) >= 300:
            assert len(found) == 3
        else:
            whole = text.replace(" ", "\u2581")
            best = pieces.best_paths("\u2581" + whole, vocab, 3) if text else [(0.0, ())]
            assert r["scores"] == pytest.approx([s for s, _ in best])  # as many as there are
        assert r["__ids"] == "mine" and r["_ids"] == "mine" and r["_round_trip"] == "mine"


def test_encoding_is_undone_by_decoding_and_by_the_model_itself(spark):
    import sentencepiece

    rows = pieces.encode(awkward(spark, "_x").drop("n_chars")).collect()
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = Counter((i, t or "") for i, t, *_ in awkward_rows())
    assert Counter((r["doc_id"], model.decode(list(r["ids"]))) for r in rows) == texts
    assert all(r["round_trip"] and sorted(r["scores"], reverse=True) == r["scores"] for r in rows)
    assert pieces.encode(empty(spark)).count() == 0


def test_archive_round_trip(spark, tmp_path):
    big = "<p>" + "x" * 200
    rows = [(5, "http://a/\nb", big), (3, None, big), (4, "u", "tiny"), (6, "u", "tiny"), (9, "u", None),
            (None, "u", big), (7, "ü", "ä" * 50)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("first", F.lit(1))
    path = f"file://{tmp_path}/archive"
    warc.write_pages(pages, path)
    found = {r["page_id"]: r for r in warc.read_pages(spark, path).collect()}
    assert len(found) == len(rows)
    assert (found[3]["record_type"], found[5]["record_type"], found[5]["refers_to"]) == ("response", "revisit", 3)
    assert found[None]["refers_to"] == 3 and found[5]["payload_bytes"] == len(big)
    assert found[5]["payload_digest"] == found[3]["payload_digest"] and found[9]["payload_bytes"] == 0
    assert found[4]["record_type"] == found[6]["record_type"] == "response"
    assert found[7]["payload_bytes"] == 100
    only = warc.read_warc(spark, path, "record_type string, target_uri string").where("record_type = 'revisit'")
    assert {r["target_uri"] for r in only.collect()} == {"http://a/%0Ab", "u"}
    assert warc.read_pages(spark, path).where("record_type = 'response'").count() == 5
    none = f"file://{tmp_path}/none"
    warc.write_pages(pages.limit(0), none)
    assert warc.read_pages(spark, none).count() == 0


def test_records_are_skipped_by_their_headers(tmp_path):
    path = tmp_path / "a.warc"
    content = b"HTTP/1.1 200 OK\r\n\r\n" + b"WARC/1.1\r\n\r\n" * 3
    path.write_bytes(
        b"".join(
            b"WARC/1.1\r\nWARC-Type: %s\r\nContent-Type: application/http\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n"
            % (kind, len(content), content)
            for kind in (b"request", b"response", b"request")
        )
    )
    reader = warc.WarcReader(str(path), [("record_type", "string"), ("payload", "binary")])
    reader.wanted.append(("warc-type", frozenset(["response"])))
    rows = [r for part in reader.partitions() for batch in reader.read(part) for r in batch.to_pylist()]
    assert rows == [{"record_type": "response", "payload": b"WARC/1.1\r\n\r\n" * 3}]


def test_language_model_against_counts(spark):
    docs = awkward(spark, "block", "role").where("doc_id IS NOT NULL")
    rows = [(i, t) for i, t, *_ in awkward_rows() if i is not None]
    found = {r["doc_id"]: r for r in lm.score_documents(docs).collect()}
    tokens = {i: [*(t or "").encode().lower().split(), None] for i, t in rows}
    fold = {i: zlib.crc32(str(i).encode()) % 7 for i in tokens}
    count = Counter(w for i, _ in rows if fold[i] != 2 for w in tokens[i])
    total, kinds = sum(count.values()), len(count)
    for i, words in tokens.items():
        r = found[i]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (fold[i] == 2, len(words), total)
        assert r["n_known"] == sum(count[w] > 0 for w in words)
        base = sum(math.log10((count[w] + 1) / (total + kinds + 1)) for w in words)
        assert r["base_score"] == pytest.approx(base) and -1e9 < r["score"] < 0
    assert lm.score_documents(empty(spark)).count() == 0
    assert lm.score_documents(awkward(spark)).count() == len(awkward_rows())


def test_the_mixed_model_is_better_on_held_out_texts(spark):
    r = random.Random(5)
    after = {w: r.sample(range(60), 3) for w in range(60)}
    rows = []
    for i in range(300):
        w, words = r.randrange(60), []
        for _ in range(80):
            words.append(f"w{w}")
            w = r.choice(after[w])
        rows.append((i, " ".join(words)))
    held = lm.score_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).where("held_out")
    base, score = held.agg(F.sum("base_score"), F.sum("score")).first()
    assert score > 0.5 * base


def test_scores_equal_a_model_in_plain_python(spark):
    r = random.Random(8)
    docs = [(i, " ".join(f"w{min(r.randrange(40), r.randrange(40))}" for _ in range(r.randrange(60)))) for i in range(80)]
    found = {x["doc_id"]: x["score"] for x in lm.score_documents(
        spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)).collect()}
    fold = {i: zlib.crc32(str(i).encode()) % 7 for i, _ in docs}
    tokens = {i: [0, *t.split(), 1] for i, t in docs}  # beginning and end

    def counts(left_out):
        words, pairs = Counter(), Counter()
        for i, t in tokens.items():
            if fold[i] not in left_out:
                words.update(t)
                pairs.update(zip(t, t[1:]))
        return words, pairs, sum(words.values()) - words[0]

    def bucket(n):
        return math.floor(math.log2(n)) + 1 if n else 0

    words, pairs, total = counts({2})
    even = 1 / (len(words) - 1 + 1)
    kept, kept_pairs, kept_total = counts({2, 6})
    cases = {}
    for i, t in tokens.items():
        if fold[i] == 6:
            for a, b in zip(t, t[1:]):
                share = kept_pairs[a, b] / kept[a] if kept[a] else 0
                cases.setdefault(bucket(kept[a]), []).append((share, kept[b] / kept_total, even))
    weights = {}
    for k, own in cases.items():
        mix = list(lm.START_WEIGHTS)
        for _ in range(lm.ROUNDS):
            sums = [0.0] * 3
            for case in own:
                part = [m * x for m, x in zip(mix, case)]
                sums = [s + x / sum(part) for s, x in zip(sums, part)]
            mix = [max(s / sum(sums), least) for s, least in zip(sums, (0, 0, lm.LEAST_EVEN))]
            mix = [m / sum(mix) for m in mix]
        weights[k] = mix
    assert len(cases) > 3
    for i, t in tokens.items():
        score = 0.0
        for a, b in zip(t, t[1:]):
            mix = weights[max([k for k in weights if k <= bucket(words[a])], default=min(weights))]
            shares = (pairs[a, b] / words[a] if words[a] else 0, words[b] / total, even)
            score += math.log10(sum(m * x for m, x in zip(mix, shares)))
        assert found[i] == pytest.approx(score, rel=1e-9)


def test_weights_learned_by_expectation_maximisation(spark):
    cases = [(8, 10, 20, 50), (0, 10, 30, 5), (0, 0, 10, 7), (3, 40, 5, 2)]
    df = spark.createDataFrame(cases, "pair bigint, context bigint, word bigint, n bigint")
    found = lm.learn_weights(df, 1000, 99, rounds=5)
    for bucket in (0, 4, 6):
        mix = list(lm.START_WEIGHTS)
        own = [c for c in cases if (math.floor(math.log2(c[1])) + 1 if c[1] else 0) == bucket]
        for _ in range(5):
            sums = [0.0] * 3
            for p, c, w, n in own:
                part = [mix[0] * (p / c if c else 0), mix[1] * w / 1000, mix[2] / 100]
                sums = [s + n * x / sum(part) for s, x in zip(sums, part)]
            mix = [s / sum(sums) for s in sums]
        assert list(found[bucket]) == pytest.approx(mix, abs=1e-5)
    assert lm.unpacked(lm.packed(found[:, 0].astype(int) + 300), len(found)).tolist() == [300] * len(found)


def test_mix_of_awkward_rows(spark):
    found = mixing.mix_documents(awkward(spark, "target", "row", "weight", "copies")).collect()
    assert len(found) == len(awkward_rows())
    assert all(r["taken"] <= 3 * r["size"] and r["target"] <= 3 * r["source_size"] for r in found)
    assert mixing.mix_documents(empty(spark)).count() == 0
    assert mixing.mixed_rows(empty(spark)).count() == 0


def test_the_mix_comes_near_its_targets_and_is_made_of_whole_documents(spark):
    rows = [(k, prose(k, 20 + k % 30), "en", None if k % 10 == 0 else f"s{k % 5}", 1) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    sizes = mixing.document_sizes(docs)
    targets = mixing.source_targets(sizes.select("source", "size"))
    by_source = {r["source"]: r["target"] for r in targets.collect()}
    assert sum(by_source.values()) == pytest.approx(sum(len(r[1].split()) for r in rows))
    found = mixing.mix(sizes, targets).withColumn("taken", F.col("copies") * F.col("size"))
    for source, taken in found.groupBy("source").agg(F.sum("taken")).collect():
        assert abs(taken - by_source[source]) <= 25
    copies = Counter(r["doc_id"] for r in mixing.mixed_rows(docs).select("doc_id").collect())
    assert copies == Counter({r["doc_id"]: r["copies"] for r in found.collect() if r["copies"]})


def test_weighted_odds_take_heavy_documents_more_often(spark):
    rows = [(k, "s", 10, str(k), 3.0 if k % 2 else 1.0) for k in range(400)]
    sizes = spark.createDataFrame(rows, "doc_id bigint, source string, size bigint, row string, w double")
    targets = spark.createDataFrame([("s", 4000, 1600.0)], "source string, source_size bigint, target double")
    found = mixing.mix(sizes, targets, weight="w").collect()
    heavy = sum(r["copies"] for r in found if r["w"] == 3.0)
    light = sum(r["copies"] for r in found if r["w"] == 1.0)
    assert heavy + light == 160 and 2 * light < heavy < 5 * light


@pytest.mark.parametrize("chunk", [4, 1024])
def test_near_duplicates_against_all_pairs(spark, monkeypatch, chunk):
    monkeypatch.setattr(minhash, "CHUNK", chunk)
    r = random.Random(2)
    rows, k = [], 0
    for group in range(12):
        base = prose(group, 150)
        for every in (0, 200, 60, 45, 40, 30, 25, 20):
            rows.append((k, edited(base, every, r.choice("xyz")) if every else base))
            k += 1
    rows += [(500 + x, rows[3][1]) for x in range(40)]  # copies
    passage = prose(77, 30)
    rows += [(600 + x, passage + " " + prose(700 + x, 60)) for x in range(60)]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == near_groups(rows)
    assert all(r["n_shingles"] == len(shingle_set(dict(rows)[r["doc_id"]])) for r in found)


def test_near_misses_of_a_bucket_are_no_pairs():
    """Copies edited so much that most are a little unlike: pairs are those of the full sets, bar held back sets."""
    texts = [edited(prose(5, 150), every, suffix) for suffix in "xyz" for every in range(18, 42, 3)]
    a, b = minhash._permutations(minhash.BANDS * minhash.BAND_ROWS)
    with np.errstate(over="ignore"):
        sets = [minhash.shingles(t, minhash._Words()) for t in texts]
        hashes = [minhash.signature(x, a, b)[: minhash.CHUNK_HASHES].astype(np.uint16).tobytes() for x in sets]
    frame = pd.DataFrame({"key": 1, "id": range(len(texts)), "component": range(len(texts)), "chunk": 0, "first": 0, "second": 0})
    frame["hashes"] = hashes
    frame["members"] = [(x >> np.uint64(32)).astype(np.uint32).tobytes() for x in sets]
    alike = {
        (x, y) for x in range(len(texts)) for y in range(x)
        if 4 * len({*sets[x]} & {*sets[y]}) >= 3 * len({*sets[x]} | {*sets[y]})
    }
    found = minhash._chunk_pairs(frame)
    assert len(found) == len(alike) > 10 and {*zip(found["a"], found["b"])} == alike
    frame.loc[3, "members"] = None
    unsure = {*zip(*minhash._chunk_pairs(frame)[["a", "b"]].to_numpy().T)}
    assert unsure > alike and all(3 in pair for pair in unsure - alike)


def test_near_duplicates_of_awkward_rows(spark):
    docs = awkward(spark, "class", "key", "component_id")
    found = minhash.near_duplicates(docs).collect()
    assert len(found) == len(awkward_rows())
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[20]["kept"] and by_id[21]["component_id"] == by_id[22]["component_id"] == 20
    assert by_id[23]["n_shingles"] == 0 and by_id[23]["component_id"] == 23 and by_id[26]["n_shingles"] == 1
    assert by_id[None]["component_id"] is None
    kept = minhash.one_of_each(docs)
    assert kept.columns == docs.columns and {21, 22}.isdisjoint({r["doc_id"] for r in kept.collect()})
    assert minhash.near_duplicates(empty(spark)).count() == 0


def test_the_bound_of_a_batch_is_that_of_the_posterior():
    for n in (32, 256):
        least = minhash.least_matches(n)
        tail = [sum(math.comb(n + 1, j) * 0.75**j * 0.25 ** (n + 1 - j) for j in range(m + 1)) for m in (least - 1, least)]
        assert tail[0] < minhash.MISS <= tail[1]


def test_components_leave_only_the_tables_that_are_read(spark):
    def stored():
        root = Path(workspace(spark).removeprefix("file://"))
        return {p.name for p in root.glob("*-*") if p.name.startswith(("links-", "least-"))}

    before = stored()
    chain = spark.createDataFrame([(k, k + 1) for k in range(40)], "a bigint, b bigint")
    assert clusters.components(chain).where("component = 0").count() == 41
    assert len(stored() - before) == 1


def test_components_of_chains_stars_and_rings(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(200, 201), (201, 202), (202, 200)]
    found = dict(clusters.components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    assert found == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 140)}, 200: 200, 201: 200, 202: 200}
    assert clusters.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_links_across_groups_of_a_bucket_are_found(spark):
    keys = spark.createDataFrame([(1, k) for k in range(30)], "key bigint, id bigint")
    links = clusters.bucket_links(keys, lambda pairs: pairs.where("abs(a - b) = 3"))
    found = dict(clusters.components(links).collect())
    assert found == {k: k % 3 for k in range(30)}


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=a>Home</a>
<li><a href=b>News</a></ul></nav><div class="cookie-notice">We use cookies, as everybody does, and you have to accept.
</div>%s<footer>&copy; us</footer></body></html>"""
ARTICLE = "<h1>Head</h1><p>First &amp; <b>fore\nmost</b> text.<br>Goes on<p>%s</p><div class='ads'>Buy this now, buy it</div><p>End."


def test_marked_article():
    page = PAGE % ("<article>" + ARTICLE % "x" + "<form>name <input></form></article><section id=comments><p>Nice article, this is, I say.</section>")
    assert html.main_text(page) == "Head\n\nFirst & fore most text. Goes on\n\nx\n\nEnd."


def test_surge_and_dive_without_a_mark():
    long = "A long paragraph that says what the page is about, in more than a few words. " * 3
    page = PAGE % ("<div><p><a href=1>one</a></p><p><a href=2>two</a></p></div><div>" + ARTICLE % long + "</div>")
    text = html.main_text(page)
    assert long.strip() in text and "cookies" not in text and "Buy" not in text and "Home" not in text
    assert html._stretches([0, 0, 100, 5, 0, 0, 0, 0, 90, 3], 3, 80, 25) == [(2, 3), (8, 9)]


def test_teasers_marked_as_articles_do_not_replace_the_text():
    long = "A long paragraph that says what the page is about, in more than a few words. " * 3
    cards = "".join(f"<article><a href={k}>Card {k}</a><p>Short teaser</p></article>" for k in range(3))
    for body in (f"<div><p>{long}</p><p>{long}</p></div>{cards}", f"{cards}<main><p>{long}</p><p>{long}</p></main>"):
        assert html.main_text(PAGE % body).count(long.strip()) == 2


def test_names_do_not_set_the_article_aside():
    long = "A long paragraph that says what the page is about, in more than a few words. " * 3
    for body in (
        f"<article class='post type-post tag-election'><p>{long}</p></article>",
        f"<article class='post legal'><p>{long}</p></article>",
        f"<div id=page class='has-sidebar'><p>{long}</p></div>",
        f"<div class='post legal'><p>{long}</p><div class='site-footer'>All of it is ours and of nobody else.</div></div>",
    ):
        assert html.main_text(PAGE % body) == long.strip()


def test_blocks_of_a_stretch_are_kept():
    long = "A long paragraph that says what the page is about, in more than a few words. " * 3
    page = PAGE % f"<div><p>{long}</p><p><a href=1>mostly a link</a> x</p><p>{long}</p><p>End.</p></div>"
    assert html.main_text(page).split("\n\n")[1:] == ["mostly a link x", long.strip(), "End."]


LONG = "A long paragraph that says what the page is about, in more than a few words. " * 3


@pytest.mark.parametrize(
    "attributes",
    ["class='user-comments'", "class='reader-comments'", "class='post-comments'", "class='ad-slot'",
     "class='cookie-consent-dialog'", "id=cookieBanner", "id=adBox", "id=comments", "class='SideBar'",
     "aria-label='Reader comments'", "class='related-stories'", "class='google-ad-300x250'"],
)
def test_parts_are_known_by_the_head_of_their_names(attributes):
    part = f"<section {attributes}><p>{'What others say or sell, at some length. ' * 3}</p></section>"
    assert html.main_text(PAGE % f"<div><p>{LONG}</p>{part}<p>{LONG}</p></div>") == f"{LONG.strip()}\n\n{LONG.strip()}"


@pytest.mark.parametrize(
    "attributes",
    ["class='has-sidebar'", "class='tag-election'", "class='post legal'", "class='with-comments'", "class='comments-open'",
     "class='entry-header'", "class='navy adventure'"],
)
def test_parts_are_not_known_by_other_words_of_their_names(attributes):
    other = "Some other thing, which is longer than the part that is named. " * 9
    page = PAGE % f"<div><p>{other}</p><section {attributes}><p>{LONG}</p></section></div>"
    assert html.main_text(page) == f"{other.strip()}\n\n{LONG.strip()}"


def test_comments_go_even_if_they_hold_most_of_the_page():
    said = "".join(f"<article class=comment><p>{LONG}</p></article>" for _ in range(5))
    for part in (f"<section class=user-comments>{said}</section>", said):
        assert html.main_text(PAGE % f"<div><p>{LONG}</p></div>{part}") == LONG.strip()
    assert html.main_text(f"<div id=comments><main><p>{LONG}</p></main></div>") == LONG.strip()


def test_short_blocks_around_a_stretch_are_taken_back():
    short = "<h1>Head</h1><p>One.</p><p>Two.</p><p>Three.</p><p>Four.</p><p>Five.</p>"
    back = ["Head", "One.", "Two.", "Three.", "Four.", "Five.", LONG.strip()]
    for body in (f"<div>{short}<p>{LONG}</p></div>", f"<div id=a>Site of ours</div>{short}<p>{LONG}</p>"):
        assert html.main_text(PAGE % body).split("\n\n") == back
    body = f"<div><p>{LONG}</p>{short}<p>{LONG}</p></div>"
    assert html.main_text(PAGE % body).split("\n\n") == [LONG.strip(), *back]


def test_controls_do_not_split_a_block():
    page = "<ul><li>Take one <button>Buy</button> of <label>size <input></label>these<svg><text>x</text></svg>.<li>Two</ul>"
    assert html.main_text(page) == "Take one of these.\n\nTwo"
    assert html.main_text("<p>One <span hidden>no</span>two <span class=ad>no</span>three") == "One two three"


def test_a_teaser_inside_the_article_goes():
    inner = f"<article class='related'><p>{LONG}</p></article>"
    assert html.main_text(PAGE % f"<article><p>{LONG}</p>{inner}<p>End.</p></article>") == f"{LONG.strip()}\n\nEnd."


def test_hostile_nesting_takes_time_in_proportion():
    n = 40_000
    start = time.monotonic()
    assert html.main_text("<div>" * n + "</x>" * n) == ""
    assert len(html.lines_of("<div class=ad>a" * n)) == n
    assert len(html.lines_of("<li>" + "<div>" * n + "a" + "<p>" * n)) == 1
    assert time.monotonic() - start < 10


def test_stretches_against_their_definition():
    r = random.Random(4)
    for _ in range(300):
        weights = [r.choice([0, 0, 5, 20, 40, 90]) for _ in range(r.randrange(25))]
        sums = [sum(weights[k : k + 3]) for k in range(len(weights))]
        found, inside = [], None
        for k, s in enumerate(sums):
            if inside is not None and s < 25:
                found, inside = [*found, (inside, k)], None
            if inside is None and s >= 80 and weights[k]:
                inside = k
        found += [(inside, len(weights))] if inside is not None else []
        assert html._stretches(weights, 3, 80, 25) == found


@pytest.mark.parametrize(
    "source, text",
    [(None, ""), ("", ""), ("plain", "plain"), ("a < b", "a < b"), ("<p>cut <b", "cut"), ("<script>x", ""),
     ("<!-- <p>no</p> --><p>&#8364;&nbsp;5</p>", "€ 5"), ("<td>1<td>2", "1\n\n2")],
)
def test_odd_pages(source, text):
    assert html.main_text(source) == text


def test_pages(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").withColumn("text", F.lit(1))
    found = {r["page_id"]: r for r in html.extract(pages).collect()}
    for row in pages.collect():
        inside = re.search(r"<article>(.*?)(</article>|$)", row["html"], re.S)[1]
        blocks = [re.sub(r"<[^>]*>", "", b.replace("<br>", " ")) for b in re.split(r"</?(?:p|h1)>", inside)]
        blocks = [re.sub(r"\s+", " ", html.unescape(b)).strip() for b in blocks]
        assert found[row["page_id"]]["text"] == "\n\n".join(b for b in blocks if b)
    assert html.extract(pages.limit(0)).count() == 0


def test_pipeline_stages(spark, tmp_path):
    docs = awkward(spark).where("doc_id IS NOT NULL")
    ids, columns = [], docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, "").write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        ids.append(Counter(r["doc_id"] for r in docs.select("doc_id").collect()))
        assert name and (k == 4 or docs.columns == columns)
    long_enough = {i for i, t, *_ in awkward_rows() if i is not None and len((t or "").split()) >= 50}
    assert set(ids[0]) == long_enough - {28, 29}  # one and the same phrase over and over
    assert {21} <= set(ids[0]) - set(ids[1]) <= {21, 22}  # the copy, and the near copy line by line
    assert set(ids[2]) == set(ids[1]) and set(ids[3]) <= set(ids[2]) and ids[4] == ids[3]
    assert docs.where("NOT round_trip").count() == 0
