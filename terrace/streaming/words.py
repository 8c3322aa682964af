"""Sensitive-word check of comment text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flag_words(df: DataFrame, text: str, words: DataFrame, word: str = "word") -> DataFrame:
    """Is the last comma-separated token of the text in the word set?

    Adds is_violation, violation_grade and violation_msg. The word set is a frame, distinct and joined by value.
    """
    side = words.select(F.col(word).alias("_word")).distinct()
    last = F.element_at(F.split(F.col(text), ","), -1)
    rows = df.withColumn("_last", last).join(side, F.col("_last") == F.col("_word"), "left")
    hit = F.col("_word").isNotNull()
    return rows.withColumns({"is_violation": hit.cast("int"), "violation_grade": F.when(hit, F.lit("P0")).otherwise(F.lit("")),
                             "violation_msg": F.when(hit, F.col("_word")).otherwise(F.lit(""))}).drop("_last", "_word")
