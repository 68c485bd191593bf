"""Registered queries of this package and their SQL counterparts."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession

from pyspark.sql import functions as F

from marketide.llm import ann, bpe, counts, exact, jaccard, langid, lines, merkle, mining, mixing, packed, quality, topk
from marketide.llm.tables import crc_bucket, read

RANKS = "byte_bpe_50k.tiktoken"
VOCABULARY = "byte_bpe_50k.json"


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn, _ = mixing.draws(read(spark, sf_dir, "documents"))
    return drawn.drop("text_key")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(read(spark, sf_dir, "documents"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_groups(read(spark, sf_dir, "documents"), words=4, percent=85)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(read(spark, sf_dir, "documents"), hash_all=True)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path(RANKS))


def op6_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read(spark, sf_dir, "embeddings"))


def op7_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = packed.scratch(spark, "ids")
    packed.write(read(spark, sf_dir, "documents"), path, public_tokenizers.path(VOCABULARY))
    return packed.read_documents(spark, path)


def held_out(buckets: int, which: int) -> Column:
    """Documents that nothing is learned from; those without an id are among them."""
    return F.coalesce(crc_bucket("doc_id", buckets) == which, F.lit(True))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    learned = langid.profiles(docs.where(~held_out(4, 2)))
    return langid.predict(docs, learned).withColumn("held_out", held_out(4, 2))


def op9_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality.learn(docs, read(spark, sf_dir, "labels").where(~held_out(5, 0)))
    scored = quality.score(docs, model).withColumn("held_out", held_out(5, 0))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = counts.token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
    return found.withColumn("over_limit", found["n_tokens"] > 1024)


def op11_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mining.hard_negatives(read(spark, sf_dir, "embeddings"), label)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    lower = F.translate("text", ascii_uppercase, ascii_lowercase)
    found = merkle.manifest(docs, F.when(crc_bucket("doc_id", 3) == 0, lower))
    return found.withColumn("proof_sha256", F.sha2("proof", 256)).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_source_mix, op2_line_dedup, op3_ngram_jaccard, op4_exact_dedup, op5_byte_bpe, op6_hilbert_neighbours,
        op7_packed_ids, op8_language_id, op9_quality_gam, op10_token_counts,
        op11_exact_topk, op12_hard_negatives, op13_merkle_manifest,
    )
}

SQL = {
    "op4_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS plain FROM documents
        ), g AS (
            SELECT plain, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY plain
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(plain) AS text_sha256
        FROM t JOIN g USING (plain)
    """,
    "op11_exact_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS q FROM embeddings
            WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op12_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
        ), positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        ), windowed AS (
            SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
                row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank
            FROM scored JOIN positives USING (anchor_id)
            WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        )
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM windowed WHERE rank <= 3
    """,
    "op13_merkle_manifest": r"""
        WITH RECURSIVE raw AS (
            SELECT doc_id, lang, list_reduce(
                [4294967295::UBIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT),
                lambda c, b: list_reduce(
                    [xor(c, b)] || range(8)::UBIGINT[],
                    lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END)
                )
            ) AS crc,
            coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
            text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered
            FROM documents
        ), hashed AS (
            SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                CASE WHEN xor(crc, 4294967295::UBIGINT) % 3 = 0 AND text IS NOT NULL
                    THEN sha256(head || strlen(lowered) || ':' || lowered) END AS told
            FROM raw
        ), leaves AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                count(*) OVER (PARTITION BY lang) AS size
            FROM hashed
        ), nodes AS (
            SELECT lang, 0 AS level, pos, leaf AS node, size FROM leaves
            UNION ALL
            SELECT lang, level + 1, pos // 8, sha256(string_agg(node, '' ORDER BY pos)), any_value((size + 7) // 8)
            FROM nodes WHERE size > 1 GROUP BY lang, level, pos // 8
        ), subroots AS (
            SELECT lang, node AS subroot, level AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos,
                count(*) OVER () AS size
            FROM nodes WHERE size = 1
        ), tops AS (
            SELECT 0 AS level, pos, subroot AS node, size FROM subroots
            UNION ALL
            SELECT level + 1, pos // 8, sha256(string_agg(node, '' ORDER BY pos)), any_value((size + 7) // 8)
            FROM tops WHERE size > 1 GROUP BY level, pos // 8
        ), runs AS (
            SELECT lang, level, pos // 8 AS run, list(node ORDER BY pos) AS members FROM nodes WHERE size > 1 GROUP BY ALL
        ), top_runs AS (
            SELECT level, pos // 8 AS run, list(node ORDER BY pos) AS members FROM tops WHERE size > 1 GROUP BY ALL
        ), named AS (
            SELECT l.*, s.subroot, s.height, s.pos AS tree, row_number() OVER () AS id,
                (SELECT node FROM tops WHERE size = 1) AS root
            FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang
        ), steps AS (
            SELECT n.id, r.level, (n.pos // (8 ** r.level)::BIGINT) % 8 AS place, members
            FROM named n JOIN runs r ON n.lang IS NOT DISTINCT FROM r.lang AND r.run = n.pos // (8 ** (r.level + 1))::BIGINT
            UNION ALL
            SELECT n.id, n.height + r.level, (n.tree // (8 ** r.level)::BIGINT) % 8, members
            FROM named n JOIN top_runs r ON r.run = n.tree // (8 ** (r.level + 1))::BIGINT
        ), parts AS (
            SELECT id, level, coalesce(array_to_string(members[:place], ''), '') AS before,
                coalesce(array_to_string(members[place + 2:], ''), '') AS after
            FROM steps
        ), proofs AS (
            SELECT id, string_agg(before || after, '' ORDER BY level) AS proof, max(level) + 1 AS height FROM parts GROUP BY id
        ), folded AS (
            SELECT id, 0 AS level, coalesce(told, leaf) AS node FROM named
            UNION ALL
            SELECT f.id, f.level + 1, sha256(before || node || after) FROM folded f JOIN parts USING (id, level)
        )
        SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, node AS folded_root, node = root AS verified
        FROM named n LEFT JOIN proofs p USING (id) JOIN folded f ON f.id = n.id AND f.level = coalesce(p.height, 0)
    """,
}
