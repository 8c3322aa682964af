"""The pipeline stage by stage against brute force on what each stage got."""

import importlib
import random
import subprocess
import sys

import pytest

import corpus_pipeline
from terrace.llm.common import documents, staged
from tests.llm.test_likeness import brute_components
from tests.llm.test_tokens import check_packing


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    out = [documents(spark, sf_dir)]
    for name, stage in corpus_pipeline.STAGES:
        out.append(staged(stage(spark, out[-1], sf_dir), name))
    return out


def test_stages_keep_the_columns_of_documents(steps):
    assert all(df.columns == steps[0].columns for df in steps[:-1])
    counts = [df.count() for df in steps[:-1]]
    assert counts[0] > counts[1] >= counts[2] == counts[3] > counts[4] > 0


def test_the_classifier_rejects_what_the_rules_keep(spark, tmp_path):
    """Low documents are rows of long numbers. All labelled ones are so short that a rule takes them; a longer one is left to the classifier."""
    r, numbers = random.Random(1), lambda n: " ".join(str(r.randrange(10 ** 9, 10 ** 10)) for _ in range(n))
    prose = lambda: " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(3, 7))) for _ in range(40))
    texts = [prose() for _ in range(300)] + [numbers(8) for _ in range(300)] + [numbers(40), prose()]
    spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 300), 0) for i in range(600)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = staged(corpus_pipeline.good_by_rules(spark, documents(spark, str(tmp_path)), str(tmp_path)), "rules")
    assert {x.doc_id for x in kept.collect()} == {*range(300), 600, 601}
    assert {x.doc_id for x in corpus_pipeline.good_by_classifier(spark, kept, str(tmp_path)).collect()} == {*range(300), 601}


def test_clean_documents_stay_and_junk_goes(spark, sf_dir, steps):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = {r.doc_id for r in steps[2].collect()}
    long = {r.doc_id for r in steps[0].collect() if len(r.text.split()) >= 30}
    good, bad = ({d for d in long if labels.get(d) == q} for q in (1, 0))
    assert len(good & kept) > 0.95 * len(good) and len(bad & kept) < 0.1 * len(bad)


def test_one_document_of_each_group(steps):
    want = brute_components({r.doc_id: r.text for r in steps[3].collect()}, 80)
    assert {r.doc_id for r in steps[4].collect()} == {k for k, (_, root) in want.items() if root == k}


def test_everything_is_packed(steps):
    rows = steps[5].collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in steps[4].collect()}
    assert check_packing(rows, 2048) <= 1 - (-sum(r.length for r in rows) // 2048)


def test_run_is_the_stages(spark, sf_dir, steps):
    assert corpus_pipeline.run(spark, sf_dir).count() == steps[5].count()


def test_library_does_without_this_subpackage():
    code = "import sys; sys.modules['terrace.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert not [q for q in e.queries() if q.startswith('op1_')] and e.oracle_sql()"
    assert subprocess.run([sys.executable, "-c", code]).returncode == 0
    assert importlib.import_module("terrace.llm")
