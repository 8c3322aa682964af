"""Queries of this subpackage by name, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from terrace.llm import line_dedup, near_dedup, quality_classifier, quality_rules
from terrace.llm.byte_bpe import round_trip_digests
from terrace.llm.common import documents
from terrace.llm.fingerprints import fingerprints
from terrace.llm.language_id import language_id
from terrace.llm.lm_scoring import lm_scores
from terrace.llm.packing import pack_documents
from terrace.llm.periodic_runs import planted, run_digests
from terrace.llm.source_mixing import mixed_words
from terrace.llm.spelling import one_left_out, spelling_variants
from terrace.llm.token_counts import token_counts


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(documents(spark, sf_dir))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_classifier(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(documents(spark, sf_dir))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(documents(spark, sf_dir))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(documents(spark, sf_dir))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir))


def op11_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_words(documents(spark, sf_dir))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(documents(spark, sf_dir), planted)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir), one_left_out)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries():
    return {f.__name__: f for f in (
        op1_token_counts, op2_byte_bpe, op3_quality_rules, op4_quality_classifier, op5_language_id, op6_line_dedup, op7_fingerprints, op8_lm_scoring, op9_packing,
        op10_near_dedup, op11_source_mixing, op12_periodic_runs, op13_spelling_variants, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {"op3_quality_rules": quality_rules.SQL, "op6_line_dedup": line_dedup.SQL, "op10_near_dedup": near_dedup.SQL}
