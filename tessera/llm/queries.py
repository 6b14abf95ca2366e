"""The registered queries of this subpackage: each applies one operator, with production parameters, to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, decontaminate, embeddings, langid, lm, packing, pii, quality, simhash, substrings
from .common import crc_mod, table


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.surrogate_pii(docs, count_column="n_entities")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(crc_mod("doc_id", 5) != 0))
    out = langid.predict(docs, model)
    return out.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", "rejected")


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_chat_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    vectors, net = quality.fit(docs, labels.where(crc_mod("doc_id", 3) != 1))
    out = quality.score(docs, vectors, net)
    return out.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(substrings.dedup_substrings(table(spark, sf_dir, "documents")))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_pii_surrogates": op2_pii_surrogates,
    "op3_language_id": op3_language_id,
    "op4_embedding_near_dedup": op4_embedding_near_dedup,
    "op5_chat_quotation_linking": op5_chat_quotation_linking,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_lm_scoring": op10_lm_scoring,
}
#: op4 and op9 have SQL. The others are beyond it (XXH64, trained models, tokenizers, alignment, keyed surrogates, quote levels);
#: tests/llm has brute force for them.
ORACLE_SQL: dict[str, str] = {
    "op4_embedding_near_dedup": """
        WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
        fine AS (
            SELECT vec_id, x FROM v
            WHERE vec_id IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND list_dot_product(x, x) > 0
        ),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
            WHERE list_dot_product(a.x, b.x) / sqrt(list_dot_product(a.x, a.x) * list_dot_product(b.x, b.x)) >= 0.9
        ),
        reach AS (SELECT a AS node, b AS other FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other),
        least AS (SELECT node, min(other) AS least FROM reach GROUP BY node),
        n AS (SELECT a AS node, count(*) AS n FROM links GROUP BY a)
        SELECT v.vec_id, coalesce(n.n, 0) AS n_links, least(v.vec_id, coalesce(least.least, v.vec_id)) AS component_id,
               v.vec_id = least(v.vec_id, coalesce(least.least, v.vec_id)) AS kept
        FROM v LEFT JOIN n ON n.node = v.vec_id LEFT JOIN least ON least.node = v.vec_id
    """,
    "op9_substring_dedup": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        places AS (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 12, 0) + 1)) AS i FROM w),
        windows AS (SELECT doc_id, i, list_aggregate(words[i:i + 12], 'string_agg', ' ') AS window_text FROM places),
        firsts AS (SELECT window_text, min(doc_id) AS first_doc FROM windows GROUP BY window_text),
        hits AS (SELECT doc_id, i FROM windows JOIN firsts USING (window_text) WHERE first_doc < doc_id),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS pos FROM hits),
        lists AS (SELECT doc_id, list(pos) AS gone_at FROM gone GROUP BY doc_id),
        kept AS (
            SELECT w.doc_id, len(words) AS n_words, coalesce(len(l.gone_at), 0) AS n_removed,
                   CASE WHEN l.gone_at IS NULL THEN words ELSE list_transform(list_filter(range(1, len(words) + 1), lambda j: NOT list_contains(l.gone_at, j)), lambda j: words[j]) END AS rest
            FROM w LEFT JOIN lists l ON l.doc_id = w.doc_id
        )
        SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
               sha256(coalesce(list_aggregate(rest, 'string_agg', ' '), '')) AS kept_sha256
        FROM kept
    """,
}
