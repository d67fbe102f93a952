"""One query per operator of this package, over the whole of its table, and its SQL if any."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    byte_bpe,
    embedding_dedup,
    html_text,
    merkle,
    nn_descent,
    packing,
    quality_rules,
    repeats,
    simhash,
    token_files,
    toxicity,
    warc,
    whitening,
)
from tidemark.llm.common import read_table

TOKEN_END_ID = 2
PACK_END_ID = 0
PACK_TOKENS = 2048


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return token_files.token_files(read_table(spark, sf_dir, "documents"), vocabulary, TOKEN_END_ID)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    model = toxicity.train(toxicity.training_rows(docs, labels))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted"
    )


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removal_report(read_table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    docs = read_table(spark, sf_dir, "documents")
    return packing.pack(docs, vocabulary, PACK_END_ID, PACK_TOKENS)


def op6_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.nearest(read_table(spark, sf_dir, "embeddings"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = read_table(spark, sf_dir, "documents")
    return byte_bpe.encode_decode(docs, ranks, public_tokenizers.PATTERN)


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(read_table(spark, sf_dir, "pages"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(read_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", F.col("payload_digest"), "record_type", "refers_to"
    )


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify_tampered(read_table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read_table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_token_files": op2_token_files,
    "op3_toxicity": op3_toxicity,
    "op4_repeats": op4_repeats,
    "op5_packing": op5_packing,
    "op6_nn_descent": op6_nn_descent,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_html_text": op9_html_text,
    "op10_warc": op10_warc,
    "op11_merkle": op11_merkle,
    "op12_whitening": op12_whitening,
    "op13_quality_rules": op13_quality_rules,
}

_SPACE = r"[\x20\x09-\x0D]"
_STOP_WORDS = ", ".join(
    f"'{form}'" for word in quality_rules.STOP_WORDS for form in {word, word.capitalize()}
)

ORACLE: dict[str, str] = {
    "op7_embedding_dedup": """
        WITH RECURSIVE vectors AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
            WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.v, b.v) >= 0.9
        ), reached AS (
            SELECT vec_id AS a, vec_id AS b FROM embeddings
            UNION
            SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
        ), least AS (
            SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a
        ), degree AS (
            SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
        )
        SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
        FROM least LEFT JOIN degree USING (vec_id)
    """,
    "op10_warc": """
        WITH payloads AS (
            SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes
            FROM pages
        ), newest AS (
            SELECT *, max(page_id) OVER (PARTITION BY html) AS response FROM payloads
        )
        SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
               CASE WHEN payload_bytes < 1000 OR page_id = response
                    THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> response THEN response END AS refers_to
        FROM newest
    """,
    "op11_merkle": """
        WITH RECURSIVE docs AS (
            SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                       AS lowered,
                   list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                                              lambda c: CAST(ord(c) AS BIGINT)),
                       lambda crc, byte: list_reduce(range(8), lambda x, step:
                           xor(x >> 1, 3988292384 * (x & 1)), xor(crc, byte)),
                       4294967295) AS remainder
            FROM documents
        ), framed AS (
            SELECT doc_id, source, (4294967295 - remainder) % 5 = 0 AS tampered, lowered, text,
                   list_aggregate(list_transform(
                       [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR)],
                       lambda v: coalesce(strlen(v) || ':' || v, '-')), 'string_agg', '') AS head
            FROM docs
        ), leaves AS (
            SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                   CASE WHEN tampered
                        THEN sha256(head || coalesce(strlen(lowered) || ':' || lowered, '-'))
                        ELSE leaf END AS claimed
            FROM framed
        ), placed AS (
            SELECT *, row_number() OVER () AS r,
                   row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
                   count(*) OVER (PARTITION BY source) AS size,
                   dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree
            FROM leaves
        ), nodes AS (
            SELECT tree, 0 AS level, idx, size, leaf AS digest FROM placed
            UNION ALL
            SELECT tree, level + 1, idx // 16, (size + 15) // 16,
                   sha256(string_agg(digest, '' ORDER BY idx))
            FROM nodes WHERE size > 1 GROUP BY tree, level, idx // 16, size
        ), crown AS (
            SELECT 0 AS level, tree AS idx, count(*) OVER () AS size, digest
            FROM nodes WHERE size = 1
            UNION ALL
            SELECT level + 1, idx // 16, (size + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx))
            FROM crown WHERE size > 1 GROUP BY level, idx // 16, size
        ), siblings AS (
            SELECT r, level AS step, nodes.idx < placed.idx // (1::BIGINT << (4 * level)) AS before,
                   nodes.idx, digest, nodes.idx = placed.idx // (1::BIGINT << (4 * level)) AS own
            FROM placed JOIN nodes ON placed.tree = nodes.tree AND nodes.size > 1
                AND nodes.idx // 16 = placed.idx // (1::BIGINT << (4 * level + 4))
            UNION ALL
            SELECT r, 100 + level, crown.idx < tree // (1::BIGINT << (4 * level)), crown.idx, digest,
                   crown.idx = tree // (1::BIGINT << (4 * level))
            FROM placed JOIN crown ON crown.size > 1
                AND crown.idx // 16 = tree // (1::BIGINT << (4 * level + 4))
        ), steps AS (
            SELECT r, row_number() OVER (PARTITION BY r ORDER BY step) AS place,
                   coalesce(string_agg(digest, '' ORDER BY idx) FILTER (before), '') AS lefts,
                   coalesce(string_agg(digest, '' ORDER BY idx) FILTER (NOT before AND NOT own), '')
                       AS rights
            FROM siblings GROUP BY r, step
        ), folded AS (
            SELECT r, 1 AS place, claimed AS digest FROM placed
            UNION ALL
            SELECT r, place + 1, sha256(lefts || digest || rights) FROM folded JOIN steps USING (r, place)
        ), proofs AS (
            SELECT r, sha256(string_agg(lefts || rights, '' ORDER BY place)) AS proof_sha256
            FROM steps GROUP BY r
        )
        SELECT doc_id, leaf, nodes.digest AS subroot, crown.digest AS root,
               coalesce(proof_sha256, sha256('')) AS proof_sha256, last.folded_root,
               last.folded_root = crown.digest AS verified
        FROM placed JOIN nodes ON placed.tree = nodes.tree AND nodes.size = 1
        JOIN crown ON crown.size = 1
        JOIN (SELECT r, arg_max(digest, place) AS folded_root FROM folded GROUP BY r) AS last USING (r)
        LEFT JOIN proofs USING (r)
    """,
    "op13_quality_rules": rf"""
        WITH docs AS (
            SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS body,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
                   list_filter(string_split(coalesce(text, ''), chr(10)),
                               lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
            FROM documents
        ), starts AS (
            SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM docs WHERE len(words) > 5
        ), windows AS (
            SELECT r, i, array_to_string(words[i : i + 4], ' ') AS w FROM starts
        ), repeated AS (
            SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, w) > 1
        ), covered AS (
            SELECT r, count(DISTINCT i + k) AS n
            FROM repeated, (SELECT unnest([0, 1, 2, 3, 4]) AS k) GROUP BY r
        ), measures AS (
            SELECT doc_id, len(words) AS n_words,
                   coalesce(list_sum(list_transform(words, lambda w: len(w))), 0) AS word_chars,
                   len(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                   len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                   coalesce(n, 0) AS n_repeat_words,
                   len(list_filter(words, lambda w: rtrim(w, '.,;:!?') IN ({_STOP_WORDS})))
                       AS n_stop_words,
                   len(list_filter(lines, lambda l: regexp_matches(l, '^{_SPACE}*[-*•]')))
                       AS n_bullet_lines,
                   len(list_filter(lines, lambda l: regexp_matches(l, '(\.\.\.|…){_SPACE}*$')))
                       AS n_cut_lines
            FROM docs LEFT JOIN covered USING (r)
        ), base AS (
            SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
            FROM measures
        )
        SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
               CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
               CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
               NOT base_failed
               AND word_chars >= 3.0 * n_words AND word_chars <= 10.0 * n_words
               AND n_symbols <= 0.1::DOUBLE * n_words
               AND (n_words < 20 OR n_stop_words >= 0.05::DOUBLE * n_words)
               AND (n_lines < 10 OR n_dup_lines <= 0.3::DOUBLE * n_lines)
               AND (n_lines < 5 OR n_bullet_lines <= 0.9::DOUBLE * n_lines)
               AND (n_lines < 5 OR n_cut_lines <= 0.3::DOUBLE * n_lines) AS kept
        FROM base
    """,
}
