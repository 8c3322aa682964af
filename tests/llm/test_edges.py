"""Every operator on nulls, empty and long texts, repeated rows, clashing column names and empty tables."""

import public_tokenizers
import pytest

import __spark_entry__
import corpus_pipeline
from terrace.llm import (byte_bpe, fingerprints, language_id, line_dedup, lm_scoring, near_dedup, packing, periodic_runs, quality_classifier, quality_rules, source_mixing, spelling,
                         token_counts)

BPE, RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
OPERATORS = {
    "token_counts": lambda d, labels: token_counts.token_counts(d, BPE),
    "byte_bpe": lambda d, labels: byte_bpe.round_trip_digests(d, RANKS, PATTERN),
    "quality_rules": lambda d, labels: quality_rules.quality_rules(d),
    "quality_classifier": lambda d, labels: quality_classifier.quality_classifier(d, labels),
    "language_id": lambda d, labels: language_id.language_id(d),
    "line_dedup": lambda d, labels: line_dedup.line_dedup(d),
    "fingerprints": lambda d, labels: fingerprints.fingerprints(d),
    "lm_scores": lambda d, labels: lm_scoring.lm_scores(d),
    "near_duplicates": lambda d, labels: near_dedup.near_duplicates(d),
    "packing": lambda d, labels: packing.pack_documents(d, BPE, PATTERN),
    "source_mixing": lambda d, labels: source_mixing.mixed_words(d),
    "periodic_runs": lambda d, labels: periodic_runs.run_digests(d),
}
FILTERS = {
    "quality_rules": lambda d, labels: quality_rules.keep_good(d),
    "quality_classifier": lambda d, labels: quality_classifier.keep_good(d, labels),
    "line_dedup": lambda d, labels: line_dedup.without_boilerplate(d),
    "near_dedup": lambda d, labels: near_dedup.one_of_each(d),
}


def values(df):
    return sorted(([str(v) for v in r] for r in df.collect()), key=str)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(name, empty, labels):
    assert OPERATORS[name](empty, labels).count() == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_other_columns_change_nothing(name, odd, clashing, labels):
    run = OPERATORS[name]
    got = run(clashing, labels)
    assert got.columns == run(odd, labels).columns
    if name != "packing":  # which of equal lengths takes which place is free
        assert values(got) == values(run(odd, labels))


@pytest.mark.parametrize("name", OPERATORS)
def test_rows_without_id_or_text(name, nameless, labels):
    got = OPERATORS[name](nameless, labels)
    assert got.count() == (2 if name == "lm_scores" else 3)  # scores are by id


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_each_row(name, odd, labels):
    got = OPERATORS[name](odd, labels)
    ids = sorted(r.doc_id for r in got.select("doc_id").collect())
    if name == "packing":
        ids = sorted(r.doc_id for r in got.filter("piece = 0").collect())
    assert ids == sorted(r.doc_id for r in odd.collect()) or name == "lm_scores" and ids == list(range(11))


@pytest.mark.parametrize("name", FILTERS)
def test_stages_return_the_columns_of_their_input(name, clashing, empty, labels):
    got = FILTERS[name](clashing, labels)
    assert got.schema.names == clashing.schema.names and [f.dataType for f in got.schema] == [f.dataType for f in clashing.schema]
    assert all(r["kept"] == "mine" for r in got.collect())
    assert FILTERS[name](empty, labels).count() == 0


def test_registered():
    names = [n for n in __spark_entry__.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries() and corpus_pipeline.ORACLE_SQL is None
