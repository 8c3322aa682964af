"""Classifier, language ID and language model by held-out accuracy and brute force."""

import math
import zlib
from collections import Counter

import numpy as np

from terrace.llm import language_id, lm_scoring, quality_classifier
from terrace.llm.common import documents


def test_classifier_on_held_out_labels(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = documents(spark, d), spark.read.parquet(f"{d}/labels.parquet")
    rows = quality_classifier.quality_classifier(docs, labels.filter("doc_id % 2 = 0")).join(labels.filter("doc_id % 2 = 1"), "doc_id").toPandas()
    assert rows[rows.quality == 1].kept.mean() > 0.97 and (~rows[rows.quality == 0].kept).mean() > 0.6  # learned from about 200 labels


def test_sparse_sites_follow_the_rates_above_them(spark):
    rows = [("bad", "x", 0.95)] * 400 + [("good", "x", 0.05)] * 400 + [("good", "y", 0.9)] + [(None, None, 0.9)]
    rates, strength = quality_classifier.site_rates(spark.createDataFrame(rows, "host string, path string, p double"))
    got = {(r.host, r.path): r for r in rates.collect()}
    assert got["bad", "x"].host_rate > 0.9 and got["good", "x"].path_rate < 0.1
    assert got["good", "x"].host_rate < got["good", "y"].path_rate < 0.9 and 0.05 < got[None, None].host_rate < 0.9 and strength >= 1


def test_without_labels_everything_stays(spark, odd, labels):
    rows = quality_classifier.quality_classifier(odd, labels.limit(0)).collect()
    assert all(r.kept and r.evidence == 0 for r in rows)


def test_profiles_are_bundles_of_bound_letters():
    text = "Ab, bä c"
    letters = [ord(c) for c in " ab bä c "]
    vectors = {c: language_id._vectors(np.array([c]))[0].astype(int) for c in letters}
    want = sum(vectors[a] * np.roll(vectors[b], 1) * np.roll(vectors[c], 2) for a, b, c in zip(letters, letters[1:], letters[2:]))
    many = language_id.profiles([text, None, "", "12", "q"] + [text] * 1200)
    assert (many[0] == want).all() and (many[-1] == want).all() and not many[1:4].any() and many[4].any()


def test_language_of_held_out_documents(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    rows = language_id.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (rows.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in rows.doc_id]).all()
    held = rows[rows.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.98 and rows.score.between(0, 1).all()


def test_language_of_texts_without_letters(spark):
    docs = spark.createDataFrame([(1, None), (2, "123 !"), (3, "abc")], "doc_id long, text string")
    prototypes = {"xx": np.ones(language_id.DIMENSIONS), "aa": np.ones(language_id.DIMENSIONS)}
    assert [(r.lang_pred, r.score) for r in language_id.predict(docs, prototypes).collect()[:2]] == [("und", 0.0)] * 2
    assert language_id.predict(docs, prototypes).collect()[2].lang_pred == "aa"
    assert {r.lang_pred for r in language_id.predict(docs, {}).collect()} == {"und"}


def brute_scores(texts):
    docs = {k: lm_scoring.words_of(t) for k, t in texts.items()}
    one, two = Counter(w for ws in docs.values() for w in ws), Counter(p for ws in docs.values() for p in zip(ws, ws[1:]))
    total = sum(one.values())

    def score(words):
        mine, pairs, others = Counter(words), Counter(zip(words, words[1:])), max(total - len(words), 1)
        word = lambda w: math.log(((one[w] - mine[w]) or lm_scoring.BACKOFF) / others)
        pair = lambda a, b: math.log((two[a, b] - pairs[a, b]) / (one[a] - mine[a])) if two[a, b] > pairs[a, b] else math.log(lm_scoring.BACKOFF) + word(b)
        return (word(words[0]) if words else 0.0) + sum(pair(a, b) for a, b in zip(words, words[1:]))
    return {k: (len(ws), score(ws)) for k, ws in docs.items()}


def check_scores(docs, texts):
    got, want = {r.doc_id: r for r in lm_scoring.lm_scores(docs).collect()}, brute_scores(texts)
    assert set(got) == set(want)
    for k, (n, score) in want.items():
        assert got[k].n_words == n and math.isclose(got[k].log_score, score, rel_tol=1e-9, abs_tol=1e-9)


def test_scores_against_brute_force(spark, sf_dir, texts):
    check_scores(documents(spark, sf_dir), texts)


def test_scores_over_many_blocks_and_buckets(spark, sf_dir, texts, monkeypatch):
    monkeypatch.setattr(lm_scoring, "BLOCK_WORDS", 700)
    monkeypatch.setattr(lm_scoring, "BUCKET_ENTRIES", 3000)
    check_scores(documents(spark, sf_dir), texts)


def test_rows_of_one_id_are_added_up(spark):
    docs = spark.createDataFrame([(1, "a b a b"), (1, "a b"), (2, None), (3, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in lm_scoring.lm_scores(docs).collect()}
    one = math.log(1 / 2) + 2 * math.log(1 / 1) + math.log(0.4) + math.log(1 / 2)  # b a backs off
    two = math.log(2 / 4) + math.log(2 / 2)
    assert got[1].n_words == 6 and math.isclose(got[1].log_score, one + two)
    assert got[2].n_words == 0 and got[3].log_score == 0 and got[2].mean_log is None


def test_pairs_and_words_that_no_other_document_has_back_off(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "a d a"), (3, "A b")], "doc_id long, text string")
    got = {r.doc_id: r.log_score for r in lm_scoring.lm_scores(docs).collect()}
    assert math.isclose(got[1], math.log(3 / 5) + math.log(1 / 3) + math.log(0.4 * 0.4 / 5))
    assert math.isclose(got[2], math.log(2 / 5) + math.log(0.4 * 0.4 / 5) + math.log(0.4 * 2 / 5))
    assert math.isclose(got[3], math.log(3 / 6) + math.log(1 / 3))


def test_a_lone_document_only_backs_off(spark):
    assert math.isclose(lm_scoring.lm_scores(spark.createDataFrame([(1, "a a b")], "doc_id long, text string")).first().log_score, math.log(0.4) + 2 * math.log(0.4 * 0.4))


def test_rare_words_of_a_large_corpus_keep_their_own_counts(spark):
    texts = {1: "f " * 150_000, 2: "u v", 3: "x y", 4: "u z", 5: "c d", **{i: "c d" for i in range(6, 12)}}
    check_scores(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), texts)


def test_classifier_by_another_id_and_from_other_documents(spark, odd, labels):
    want = {tuple(r) for r in quality_classifier.quality_classifier(odd, labels).collect()}
    renamed = quality_classifier.quality_classifier(odd.withColumnRenamed("doc_id", "key"), labels.withColumnRenamed("doc_id", "key"), 0.8, "key")
    assert {tuple(r) for r in renamed.collect()} == want
    assert {tuple(r) for r in quality_classifier.quality_classifier(odd, labels, learn_from=odd).collect()} == want


def test_no_text_is_shuffled_to_its_labels(spark, odd, labels):
    bins = odd.select("doc_id", quality_classifier.bins_of(odd.text).alias("bins"))
    seen = []
    held = quality_classifier.fit_evidence
    try:
        quality_classifier.fit_evidence = lambda known, *rest: (seen.append(known), held(known, *rest))[1]
        quality_classifier.classified(odd, labels, learn_from=odd)
    finally:
        quality_classifier.fit_evidence = held
    assert seen[0].columns == ["id", "bins"] and seen[0].count() == bins.count()  # all rows, before any join
    plan = seen[0].join(labels.withColumnRenamed("doc_id", "id").hint("merge"), "id")._jdf.queryExecution().executedPlan().toString()
    assert all("text" not in line for line in plan.splitlines() if "Exchange" in line)
