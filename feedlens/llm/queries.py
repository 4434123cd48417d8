"""The registered queries of the numbered operators and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.llm import alignment, exact_dedup, lm_score, mixing, near_dedup, neighbours, packing, quality_classifier, quality_rules, spelling, token_binary, token_count, url_filter


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(_table(spark, sf_dir, "pages", "page_id", "url"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_scores(_table(spark, sf_dir, "documents", "doc_id", "text"), _table(spark, sf_dir, "labels", "doc_id", "quality"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents", "doc_id", "text", "source"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_scores(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    read = token_binary.token_binary(docs, _tokenizer("word_bpe_49k.json"), None, 2)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_count.token_counts(_table(spark, sf_dir, "documents", "doc_id", "text"), _tokenizer("byte_bpe_50k.json"))
    return counted.select("*", (F.col("n_tokens") > 1024).alias("over_limit"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents", "doc_id", "text"), _tokenizer("word_bpe_49k.json"), 1)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.token_alignment(_table(spark, sf_dir, "documents", "doc_id", "text"), _tokenizer("byte_bpe_50k.json"), _tokenizer("piece_bpe_32k.model"))


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_exact_dedup, op2_near_dedup, op3_url_filter, op4_quality_classifier, op5_source_mix, op6_lm_score, op7_token_binary, op8_token_counts,
        op9_best_fit_packing, op10_quality_rules, op11_token_alignment,
        op12_nearest_neighbours, op13_spelling_variants,
    )
}

ORACLE_SQL: dict[str, str] = {"op1_exact_dedup": exact_dedup.oracle_sql(), "op3_url_filter": url_filter.oracle_sql()}
