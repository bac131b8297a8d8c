"""The registered queries of this package, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from closeworks.llm.common import table
from closeworks.llm.decontamination import find_leaks
from closeworks.llm.importance_sampling import resample
from closeworks.llm.jaccard_join import near_duplicates
from closeworks.llm.language_id import identify_languages
from closeworks.llm.packing import pack_documents
from closeworks.llm.quality_classifier import score_quality
from closeworks.llm.quality_rules import apply_rules
from closeworks.llm.secret_scans import scan_secrets
from closeworks.llm.substring_dedup import dedup_words
from closeworks.llm.suffix_dedup import dedup_bytes
from closeworks.llm.toxicity import score_toxicity
from closeworks.llm.url_filters import Rule, judge_urls
from closeworks.llm.vector_codes import encode_vectors

URL_RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_bytes(table(spark, sf_dir, "documents"))


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents")).drop("text_hash")


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        ranks_path=public_tokenizers.path("byte_bpe_50k.tiktoken"),
    )


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_words(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_importance_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_vectors(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_secret_scans": op2_secret_scans,
    "op3_url_filters": op3_url_filters,
    "op4_decontamination": op4_decontamination,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_packing": op6_packing,
    "op7_language_id": op7_language_id,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_toxicity": op11_toxicity,
    "op12_importance_sampling": op12_importance_sampling,
    "op13_vector_codes": op13_vector_codes,
}
