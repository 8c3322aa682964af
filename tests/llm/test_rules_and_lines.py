"""Quality rules and line dedup against their SQL and against small cases."""

import pytest
from pyspark.sql import functions as F

from oracles.compare import compare, connect
from terrace.llm import line_dedup, quality_rules, registry


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, registry.queries()[name], registry.oracle_sql()[name]) is None


def test_repeated_windows_and_lines(spark):
    data = [(1, "a b c d e x a b c d e"), (2, "a b c d e f"), (3, "a a a a a a a"), (4, "l1 w\nl1 w\n\n \nl1 w \nl2"), (5, "a|b #c $d"), (6, None)]
    rows = {r.doc_id: r for r in quality_rules.quality_rules(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert [rows[i].n_repeat_words for i in range(1, 7)] == [10, 0, 7, 0, 0, 0]
    assert (rows[4].n_lines, rows[4].n_dup_lines) == (4, 1) and rows[5].n_symbols == 3 and rows[1].n_words == 11
    assert rows[6].n_words == 0 and rows[6].base_failed and not rows[6].kept


def test_policies_and_ablations(spark, odd):
    ledger = quality_rules.ledger(odd).cache()
    bits = [r.b for r in ledger.select(F.col("ledger.failure_bits").alias("b")).collect()]
    mask = quality_rules.policy_mask("2024.2")
    for r in quality_rules.ablations(ledger, "2024.2").collect():
        bit = quality_rules.BITS[r.rule]
        assert (r.n_failed, r.n_only, r.n_rejected_without) == (sum(bool(b & bit) for b in bits), sum(b & mask == bit for b in bits), sum(bool(b & mask & ~bit) for b in bits))
    assert quality_rules.keep_good(odd).count() == sum(b & mask == 0 for b in bits)


def test_clean_documents_stay_and_junk_goes(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    marks = quality_rules.quality_rules(docs).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").filter(~F.col("base_failed")).toPandas()
    assert marks[marks.quality == 1].kept.mean() > 0.97 and (~marks[marks.quality == 0].kept).mean() > 0.9


def test_boilerplate_is_relative_to_its_site(spark):
    pages = [(i, f"Menu \nbody {i}\n\nMenu", "big") for i in range(30)] + [(100 + i, f"Menu\nother {i}", "small") for i in range(6)] + [(200, "Menu\nx", None), (201, None, "big")]
    pages += [(300 + i, "Menu\npage" + str(i), "rare") if i < 6 else (300 + i, f"page {i}", "rare") for i in range(40)]
    docs = spark.createDataFrame(pages, "doc_id long, text string, source string").withColumn("n_chars", F.char_length("text").cast("long"))
    rows = {r.doc_id: r for r in line_dedup.line_dedup(docs).collect()}
    assert rows[3].text == "body 3\n" and (rows[3].n_lines, rows[3].n_dropped) == (3, 2)
    assert rows[101].text == "other 1" and rows[200].text == "Menu\nx" and rows[201].text is None
    assert rows[301].text == "Menu\npage1"  # on 6 of 40 pages, which chance alone could give a line with a share of 5 %
    shorter = {r.doc_id: r for r in line_dedup.without_boilerplate(docs).collect()}
    assert shorter[3].n_chars == 7 and shorter[101].n_chars == 7 and shorter[201].n_chars is None and shorter[301].n_chars == 10


@pytest.mark.parametrize("n, hits, dropped", [(1, 1, False), (2, 2, False), (3, 3, True), (4, 4, True), (4, 3, True), (4, 2, False), (19, 19, True), (19, 5, True), (19, 4, False), (100, 13, True), (100, 12, False)])
def test_few_pages_need_a_larger_share(spark, n, hits, dropped):
    docs = spark.createDataFrame([(i, f"line {i}" + ("\nMenu" if i < hits else ""), "s") for i in range(n)], "doc_id long, text string, source string")
    assert {r.n_dropped for r in line_dedup.line_dedup(docs).filter(f"doc_id < {hits}").collect()} == {int(dropped)}


def test_text_of_boilerplate_only_becomes_empty(spark):
    docs = spark.createDataFrame([(i, "Menu", "s") for i in range(20)], "doc_id long, text string, source string")
    assert {r.text for r in line_dedup.line_dedup(docs).collect()} == {""}
