import random

import pytest

CLASHING = "n_words, kept, row, ledger, id, key, bucket, size, n, m, value, label, component_id, anchors, evidence, host, path, lines, sequence_id, offset, length, piece, words, sig, held_out".split(", ")


@pytest.fixture(scope="session")
def long_text():
    r = random.Random(7)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(1, 9))) + r.choice(["", "", ".\n", ","]) for _ in range(20_000))


@pytest.fixture(scope="session")
def odd_rows(long_text):
    """doc_id, text, lang, source, n_chars with nulls, empty and very long texts, repeated rows and ties."""
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(0, None, "en", "s"), (1, "", "en", "s"), (2, " \t\n ", None, "s"), (3, "word", "en", None), (4, text, "en", "s"), (5, text, "de", "s"), (5, text, "de", "s"),
            (6, text.upper(), "en", "s"), (7, long_text, "en", "s"), (8, long_text + " end", "fr", None), (9, "x" * 5000, "en", "s"), (10, "naïve é中文😀 ​<|endoftext|> a", "en", "s")]
    return [(*r, len(r[1]) if r[1] is not None else None) for r in rows]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def clashing(odd):
    from pyspark.sql import functions as F
    return odd.select("*", *(F.lit("mine").alias(c) for c in CLASHING))


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def nameless(spark):
    return spark.createDataFrame([(None, "a b c d e f", None, None, None), (None, None, None, None, None), (3, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (5, 0, 0), (5, 0, 1), (None, 0, 0), (99, 1, None), (7, None, 0)], "doc_id long, quality int, toxic int")


def texts_of(sf_dir):
    import pyarrow.parquet as pq
    return {r["doc_id"]: r["text"] for r in pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()}


@pytest.fixture(scope="session")
def texts(sf_dir):
    return texts_of(sf_dir)
