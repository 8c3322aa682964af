"""From raw documents to packed training sequences: five stages, each written and read again before the next one.

Quality rules and the quality classifier drop documents, line dedup shortens texts, near-dedup keeps the smallest id of each group
(at a similarity of 0.8), and packing places what is left. All stages but the last return the columns of their input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from terrace.llm import line_dedup, near_dedup, quality_classifier, quality_rules
from terrace.llm.common import documents, staged
from terrace.llm.packing import pack_documents


def good_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def good_by_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # What the rules have left holds hardly any low-quality label, so the classifier learns from all labelled documents.
    return quality_classifier.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), learn_from=documents(spark, sf_dir))


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.without_boilerplate(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.one_of_each(docs, percent=80)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", good_by_rules),
    ("quality_classifier", good_by_classifier),
    ("line_dedup", without_boilerplate),
    ("near_dedup", one_of_each_group),
    ("packing", packed),
]

#: A learned classifier and a tokenizer are no SQL; the tests check the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
