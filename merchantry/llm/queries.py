"""Registered queries of the text operators, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import workspace
from . import html, infill, lines, lm, minhash, mixing, packing, pieces, ring, rules, syncmers, trie, warc

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def op1_syncmer_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents and of edited texts, and how alike they are."""
    found = syncmers.fingerprint_edits(_read(spark, folder, "documents"))
    return found.withColumns(
        {c: syncmers.fingerprint_text(F.col(c)) for c in ("fingerprint", "edited_fingerprint")}
    )


def op2_ring_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 16 shards whose row counts are at most one apart."""
    return ring.shard_documents(_read(spark, folder, "documents"), 16).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_piece_segmentations(spark: SparkSession, folder: str) -> DataFrame:
    """The three best segmentations of every document."""
    return pieces.encode(_read(spark, folder, "documents").select("doc_id", "text"))


def op4_warc_records(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written to an archive and read back."""
    path = f"{workspace(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_pages(_read(spark, folder, "pages"), path)
    return warc.read_pages(spark, path)


def op5_deleted_interpolation(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of every document by the base and by the interpolated model."""
    return lm.score_documents(_read(spark, folder, "documents"))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base measures and verdict of every document."""
    return rules.judge_documents(_read(spark, folder, "documents"))


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Text of every document without lines that stand earlier in the corpus."""
    return lines.without_repeats(_read(spark, folder, "documents")).select(
        "doc_id", "n_lines", "dropped_lines", "text"
    )


def op8_pareto_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document in a mix of all sources by their weights."""
    return mixing.mix_documents(_read(spark, folder, "documents"))


def op9_minhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Group of near-duplicates of every document."""
    return minhash.near_duplicates(_read(spark, folder, "documents"))


def op10_line_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return html.extract(_read(spark, folder, "pages"))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Nodes of the prefix trie of all conversations."""
    return trie.prefix_trie(_read(spark, folder, "conversations"))


def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as prefix, suffix and middle, and rebuilt from that."""
    found = infill.fill_in_middle(_read(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op13_vector_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of all documents in sequences of at most 2048."""
    return packing.pack_documents(_read(spark, folder, "documents"))


_OP4_SQL = """
WITH digests AS (
    SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
        sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM digests
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END
        AS record_type,
    CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM firsts
"""

_OP6_SQL = r"""
WITH measured AS (
    SELECT doc_id, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
        [x FOR x IN string_split(coalesce(text, ''), chr(10))
            IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
    FROM documents
), numbered AS (
    SELECT doc_id, row_number() OVER () AS r, t, w, lines FROM measured
), windows AS (
    SELECT r, i, w[i:i + 2] AS g
    FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM numbered)
), repeated AS (
    SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, g) > 1
), covered AS (
    SELECT r, count(DISTINCT p) AS n
    FROM (SELECT r, unnest(range(i, i + 3)) AS p FROM repeated) GROUP BY r
), base AS (
    SELECT doc_id, len(w)::BIGINT AS n_words,
        length(array_to_string(w, ''))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(n, 0)::BIGINT AS n_repeat_words,
        len(lines) AS n_lines,
        length(regexp_replace(t, '\P{L}+', '', 'g')) AS n_letters
    FROM numbered LEFT JOIN covered USING (r)
), failing AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT (base_failed OR 10 * n_symbols > n_words
        OR NOT word_chars BETWEEN 2 * n_words AND 16 * n_words
        OR 10 * n_dup_lines > 3 * n_lines OR 10 * n_letters < 6 * word_chars) AS kept
FROM failing
"""

# The share is raised until no source that is not stopped goes over three times its size.
_OP8_SQL = r"""
WITH RECURSIVE sized AS (
    SELECT doc_id, source, md5(coalesce(text, '')) AS row_hash,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
    FROM sized GROUP BY source
), shares(step, share) AS (
    SELECT 0, 0::DOUBLE
    UNION ALL
    SELECT step + 1, (
        SELECT (sum(source_size) - coalesce(sum(3 * source_size)
                FILTER (weight * share > 3 * source_size), 0))::DOUBLE
            / (sum(weight) FILTER (weight * share <= 3 * source_size))::DOUBLE
        FROM sources)
    FROM shares WHERE step < (SELECT count(*) + 1 FROM sources)
), final AS (
    SELECT max(share) AS share FROM shares
), targets AS (
    SELECT source, source_size,
        CASE WHEN weight * share > 3 * source_size THEN (3 * source_size)::DOUBLE
            ELSE weight * share END AS target
    FROM sources, final
), wanted AS (
    SELECT s.*, t.source_size, t.target,
        CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS copies,
        (('0x' || substr(md5(concat_ws('|', 'mix', s.doc_id::VARCHAR, s.row_hash)), 1, 13))::BIGINT
            + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), ranked AS (
    SELECT *, floor(copies)::BIGINT AS whole,
        CASE WHEN copies > floor(copies) AND size > 0 THEN
            (u / (1 - u)) / ((copies - floor(copies)) / (1 - (copies - floor(copies)))) END AS odds
    FROM wanted
), placed AS (
    SELECT *, sum(floor(copies)::BIGINT * size) OVER (PARTITION BY source) AS certain,
        sum(size) OVER (PARTITION BY source ORDER BY odds, doc_id, row_hash
            ROWS UNBOUNDED PRECEDING) - size AS before
    FROM ranked WHERE odds IS NOT NULL
    UNION ALL
    SELECT *, NULL, NULL FROM ranked WHERE odds IS NULL
)
SELECT doc_id, size, source_size, target,
    ((whole + CASE WHEN odds IS NOT NULL AND before + size / 2 <= target - certain
        THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM placed
"""

_OP12_SQL = """
WITH digests AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d,
        regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u
    FROM documents
), drawn AS (
    SELECT doc_id, t, u, len(u)::BIGINT AS n,
        ('0x' || d[1:8])::BIGINT % (len(u) + 1) AS a, ('0x' || d[9:16])::BIGINT % (len(u) + 1) AS b,
        CASE WHEN t = '' OR regexp_matches(t, '<[PSM]>') OR ('0x' || d[17:24])::BIGINT % 100 >= 90
            THEN 'plain' WHEN ('0x' || d[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM digests
), cut AS (
    SELECT doc_id, t, n, form, array_to_string(u[:least(a, b)], '') AS p,
        array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m,
        array_to_string(u[greatest(a, b) + 1:], '') AS s
    FROM drawn
)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM cut
"""

QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_syncmer_fingerprints,
        op2_ring_shards,
        op3_piece_segmentations,
        op4_warc_records,
        op5_deleted_interpolation,
        op6_quality_rules,
        op7_line_dedup,
        op8_pareto_mix,
        op9_minhash_groups,
        op10_line_blocks,
        op11_prefix_trie,
        op12_fill_in_middle,
        op13_vector_packing,
    )
}

SQL: dict[str, str] = {
    "op4_warc_records": _OP4_SQL,
    "op6_quality_rules": _OP6_SQL,
    "op8_pareto_mix": _OP8_SQL,
    "op12_fill_in_middle": _OP12_SQL,
}
