"""Line dedup by site-relative frequency.

A line is boilerplate of a host if it is on more than a given share of the host's pages, beyond what chance would add on that many pages: on
1,000 pages hits must exceed the share by a fiftieth of the pages, on 4 pages 3 of them say enough, and on 2 pages nothing does. Lines are compared without the white
space around them, by a 64-bit hash within one host; counts are combined before the shuffle, so neither a common line nor a large
host meets in one task. A page holds a bounded number of lines on average, so a host has at most (mean lines per page / ratio)
boilerplate lines: these sets are small and travel to the pages, not the pages to them. All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import WORD_GAPS, staged


def _line_hash(line: Column) -> Column:
    return F.xxhash64(F.btrim(line, F.lit(WORD_GAPS)))


def _lines(text: Column) -> Column:
    """Lines that hold something else than white space."""
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def least_hits(pages: Column, ratio: float, sigmas: float) -> Column:
    """How many pages a line may be on and still count as content: the share, the deviation that chance gives it, and one page."""
    return 1 + F.lit(ratio) * pages + F.lit(sigmas) * F.sqrt(F.lit(ratio * (1 - ratio)) * pages)


def boilerplate(docs: DataFrame, ratio: float, sigmas: float, host_column: str = "source", text_column: str = "text") -> DataFrame:
    """Return host and lines (array of hashes) for hosts that have boilerplate: lines on more pages than `least_hits` allows. Pages without a
    host belong to none."""
    pages = docs.select(F.col(host_column).alias("host"), F.col(text_column).alias("text")).filter("host IS NOT NULL")
    totals = pages.groupBy("host").agg(F.count("*").alias("pages"))
    hits = (pages.select("host", F.explode(F.array_distinct(F.transform(_lines(F.col("text")), _line_hash))).alias("line"))
            .groupBy("host", "line").agg(F.count("*").alias("hits")).filter("hits > 1"))
    return (hits.join(totals, "host").filter(F.col("hits") > least_hits(F.col("pages"), ratio, sigmas))
            .groupBy("host").agg(F.collect_list("line").alias("lines")))


def drop_boilerplate(docs: DataFrame, ratio: float = 0.05, sigmas: float = 3.0, host_column: str = "source", text_column: str = "text") -> DataFrame:
    """Return `row` (the whole input row), n_lines and n_dropped (of lines that aren't blank) and kept_text.

    kept_text is the text without its host's boilerplate lines; blank lines and the order stay. A page without a host, or of a host
    that has no boilerplate, keeps its text; a null text stays null with 0 lines; a text of boilerplate only becomes empty. Repeated
    rows are pages of their own. An empty table gives an empty one. Clashing column names stay inside `row`.
    """
    sets = staged(boilerplate(docs, ratio, sigmas, host_column, text_column), "boilerplate")
    rows = docs.select(F.struct("*").alias("row"), F.col(host_column).alias("host"), F.col(text_column).alias("text"))
    joined = rows.join(sets.withColumnRenamed("lines", "drop"), "host", "left").withColumn("lines", F.split("text", "\n"))
    kept = F.filter("lines", lambda line: ~(F.array_contains("drop", _line_hash(line)) & line.rlike(r"[^\x20\x09-\x0D]")))
    joined = joined.withColumn("kept", F.when(F.col("drop").isNull(), F.col("lines")).otherwise(kept))
    return joined.select(
        "row", F.coalesce(F.size(_lines(F.col("text"))), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("lines") - F.size("kept"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.array_join("kept", "\n")).alias("kept_text"))


def line_dedup(docs: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """Return id, n_lines, n_dropped and text (without boilerplate) for every row; see `drop_boilerplate`."""
    return drop_boilerplate(docs, **options).select(F.col(f"row.{id_column}").alias(id_column), "n_lines", "n_dropped", F.col("kept_text").alias("text"))


def without_boilerplate(docs: DataFrame, text_column: str = "text", length_column: str | None = "n_chars", **options) -> DataFrame:
    """The input with boilerplate dropped from its texts; a column of text lengths, where there is one, follows the new texts."""
    rows = drop_boilerplate(docs, text_column=text_column, **options)
    changed = {text_column: F.col("kept_text")}
    if length_column in docs.columns:
        same = F.col("n_dropped") == 0
        changed[length_column] = F.when(same, F.col(f"row.{length_column}")).otherwise(F.char_length("kept_text")).cast(docs.schema[length_column].dataType)
    return rows.select(*(changed.get(c, F.col(f"row.{c}")).alias(c) for c in docs.columns))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, * FROM documents),
l AS (SELECT k, source, i, line, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM (SELECT k, source, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM d)),
pages AS (SELECT source, count(*) AS n FROM d GROUP BY source),
bad AS (SELECT source, body FROM l JOIN pages USING (source) WHERE body <> '' GROUP BY source, body, n HAVING count(DISTINCT k) > 1 + CAST(0.05 AS DOUBLE) * n + 3 * sqrt(CAST(0.05 AS DOUBLE) * CAST(0.95 AS DOUBLE) * n)),
m AS (SELECT l.*, bad.body IS NOT NULL AS dropped FROM l LEFT JOIN bad USING (source, body)),
g AS (SELECT k, count(*) FILTER (body <> '') AS n_lines, count(*) FILTER (dropped) AS n_dropped, string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped) AS text FROM m GROUP BY k)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(g.text, '') END AS text FROM d LEFT JOIN g USING (k)
"""
