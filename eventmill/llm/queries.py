"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.llm import (bwt_dedup, decontamination, divergence, embedding_dedup, html_extraction, licenses, mixing, pii, simhash, tokencount,
                           toxicity, urlfilter, whitening)
from eventmill.llm.common import table

QueryFn = Callable[[SparkSession, str], DataFrame]

#: The rules that op6_url_filter is asked to apply.
URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_entities", "kinds")


def op4_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(table(spark, sf_dir, "pages"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict", "score")


def op7_bwt_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bwt_dedup.deduplicate(table(spark, sf_dir, "documents"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", simhash.hex_print().alias("fingerprint"), "component_id")


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings")).drop("residual")


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def queries() -> dict[str, QueryFn]:
    return {f.__name__: f for f in (op1_decontamination, op2_toxicity, op3_pii_surrogates, op4_html_main_text, op5_license_scan, op6_url_filter, op7_bwt_substring_dedup, op8_embedding_dedup, op9_simhash_dedup, op10_mix_sources,
                                   op11_embedding_whitening, op12_token_counts, op13_source_divergence)}


def oracle_sql() -> dict[str, str]:
    return {
        "op5_license_scan": licenses.scan_sql(),
        "op10_mix_sources": f"SELECT doc_id, size, source_size, target, taken FROM ({mixing.mix_sql()})",
        "op13_source_divergence": divergence.audit_sql(),
    }
