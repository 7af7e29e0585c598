"""The queries of this subpackage: (spark, sf_dir) -> DataFrame over whole tables, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontamination, fingerprints, html_extract, language_id, lm_score, near_dedup, packing, quality, secrets, substring_dedup
from tidemark.llm.common import table


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_report(table(spark, sf_dir, "documents"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents")).drop("clean")


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.duplicate_spans(table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.scores(table(spark, sf_dir, "documents"))


def tokenizer_path() -> str:
    """The public vocabulary that packing is asked to use; operators take a path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_document_fingerprints": op2_document_fingerprints,
    "op3_html_extraction": op3_html_extraction,
    "op4_language_id": op4_language_id,
    "op5_secret_scans": op5_secret_scans,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_best_fit_packing": op10_best_fit_packing,
}

ORACLES: dict[str, str] = {
    # every window that starts with an item's shingle, each compared with every item of its length
    "op1_benchmark_decontamination": r"""
        WITH split AS (
            SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark
        ), items AS (
            SELECT item_id, w, len(w) AS length, least(5, len(w)) AS size, len(w) - least(5, len(w)) + 1 AS inside FROM split WHERE len(w) > 0
        ), item_at AS (
            SELECT *, unnest(range(inside)) AS place FROM items
        ), item_shingles AS (
            SELECT item_id, length, size, inside, array_to_string(w[place + 1 : place + size], ' ') AS h, count(*) AS m FROM item_at GROUP BY ALL
        ), docs AS (
            SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents WHERE doc_id IS NOT NULL
        ), doc_at AS (
            SELECT doc_id, w, size, unnest(range(greatest(len(w) - size + 1, 0))) AS p FROM docs, (SELECT DISTINCT size FROM items)
        ), doc_shingles AS (
            SELECT doc_id, p, size, array_to_string(w[p + 1 : p + size], ' ') AS h FROM doc_at
        ), anchors AS (
            SELECT DISTINCT doc_id, p, length, inside, h FROM doc_shingles JOIN item_shingles USING (size, h)
        ), windows AS (
            SELECT a.doc_id, a.length, a.p AS start, b.h, count(*) AS n
            FROM (SELECT DISTINCT doc_id, length, inside, p FROM anchors) a JOIN anchors b ON a.doc_id = b.doc_id AND a.length = b.length AND b.p BETWEEN a.p AND a.p + a.inside - 1
            GROUP BY ALL
        ), scored AS (
            SELECT doc_id, item_id, start, w.length, sum(least(n, m)) / any_value(inside) AS similarity
            FROM windows w JOIN item_shingles i ON w.length = i.length AND w.h = i.h
            GROUP BY ALL HAVING sum(least(n, m)) / any_value(inside) >= 0.8
        )
        SELECT doc_id, item_id, similarity, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length FROM scored
        QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start, length) = 1
    """,
}
