"""Fingerprints and near-dedup against brute force."""

import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from terrace.llm import fingerprints, near_dedup
from terrace.llm.common import documents


def edited_text(texts, order, i):
    text, following = texts[order[i]] or "", texts[order[(i + 1) % len(order)]] or ""
    quarter = len(text) // 4
    return text[:len(text) - quarter] + following[:quarter]


def parsed(fingerprint):
    return [(int(h), int(at)) for at, h in (x.split(":") for x in fingerprint.split())]


def like(a, b):
    """By all bands instead of a walk over the sorted ones."""
    if not a and not b:
        return 1
    both = sorted([(h, at, 0) for h, at in a] + [(h, at, 1) for h, at in b])
    offsets = [(y[1] - x[1]) * (1 if x[2] == 0 else -1) for x, y in zip(both, both[1:]) if x[0] == y[0] and x[2] != y[2]]
    band = max(16, max(x[-1][1] if x else 0 for x in (a, b)) // 8)
    bands = Counter(d // band for d in offsets)
    most = max((n + bands.get(k + 1, 0) for k, n in bands.items()), default=0)
    return 2 * min(most, len(a), len(b)) / (len(a) + len(b))


def closed_syncmers(text):
    """Starts of the runs of 7 words whose smallest inner run of 2 is the first or the last."""
    import xxhash
    words = [b""] * 6 + (text or "").encode().split()
    inner = []
    for a, b in zip(words, words[1:]):
        h = xxhash.xxh64_intdigest(b, xxhash.xxh64_intdigest(a, 42))
        inner.append(h - (1 << 64) if h >> 63 else h)
    runs = [inner[i:i + 6] for i in range(len(inner) - 5)]
    return [i for i, run in enumerate(runs) if min(run) in (run[0], run[-1])]


def test_passages_in_another_order_or_repeated_are_less_alike(spark):
    r = random.Random(3)
    passages = [" ".join(f"w{r.randrange(10 ** 6)}" for _ in range(60)) for _ in range(6)]
    whole, mirrored, five = " ".join(passages), " ".join(passages[::-1]), " ".join([passages[0]] * 5)
    late = "a few words before it all begins " + whole
    rows = [(i, t) for i, t in enumerate([whole, whole, late, whole, mirrored, passages[0], five])]
    near = {x.doc_id: x.near_next for x in fingerprints.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert near[0] == 1 and near[1] > 0.9 and near[3] < 0.4 and near[5] < 0.5


def test_fingerprints_of_documents(spark, sf_dir, texts):
    rows = {r.doc_id: r for r in fingerprints.fingerprints(documents(spark, sf_dir)).collect()}
    order = sorted(texts)
    assert set(rows) == set(order)
    for i, doc in enumerate(order):
        r, text = rows[doc], edited_text(texts, order, i)
        assert r.n_chars == len(texts[doc]) and r.edited_sha256 == hashlib.sha256(text.encode()).hexdigest()
        mine, edited, following = (parsed(x) for x in (r.fingerprint, r.edited_fingerprint, rows[order[(i + 1) % len(order)]].fingerprint))
        assert r.near_edited == pytest.approx(like(mine, edited)) and r.near_next == pytest.approx(like(mine, following))
        if i % 10 == 0:
            assert [at for _, at in mine] == closed_syncmers(texts[doc])
    long = [r for d, r in rows.items() if len(texts[d].split()) > 50]
    assert sum(r.near_edited > 0.6 and r.near_next < 0.2 for r in long) > 0.95 * len(long)


def test_equal_texts_have_equal_fingerprints(spark):
    words = [f"w{i}" for i in range(60)]
    body = " ".join(words)
    rows = {r.doc_id: r for r in fingerprints.fingerprints(spark.createDataFrame([(1, body), (5, "lead in " + body), (9, body.replace(" ", "\n")), (12, "")], "doc_id long, text string")).collect()}
    assert rows[1].fingerprint == rows[9].fingerprint != rows[5].fingerprint and rows[12].fingerprint == ""
    assert rows[1].near_next > 0.7 and len(rows[1].fingerprint.split()) > 10


def test_a_lone_document_is_its_own_next(spark):
    r = fingerprints.fingerprints(spark.createDataFrame([(4, "a b c d e f g h i j k l")], "doc_id long, text string")).first()
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256(b"a b c d e f g h i a b c").hexdigest() or r.n_chars == 23


def test_next_over_many_ranges(spark):
    docs = spark.createDataFrame([(i * i * (-1) ** i, f"t{i}") for i in range(300)], "doc_id long, text string")
    got = {r.key: r.next_text for r in fingerprints.with_next(docs.withColumnRenamed("doc_id", "key"), "key", ["text"]).collect()}
    order = sorted(got)
    text = {r.doc_id: r.text for r in docs.collect()}
    assert got == {k: text[order[(i + 1) % len(order)]] for i, k in enumerate(order)}


def shingles(text, width=5):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(dict.fromkeys(range(9, 14), " ")).split(" ") if w]
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)} if len(words) >= width else {tuple(words)} if words else set()


def brute_components(texts, percent):
    sets = {k: shingles(t) for k, t in texts.items()}
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    holders = {}
    for k, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(k)
    for a, s in sets.items():
        for b, n in Counter(b for g in s for b in holders[g] if b > a).items():
            if 100 * n >= percent * (len(s) + len(sets[b]) - n):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {k: (len(sets[k]), root(k)) for k in sets}


def family(r, size, words, edits):
    """A text and copies of it with some words changed."""
    base = [f"w{r.randint(0, 10 ** 6)}" for _ in range(words)]
    for _ in range(size):
        copy = list(base)
        for _ in range(r.randint(0, edits)):
            copy[r.randrange(words)] = f"x{r.randint(0, 10 ** 6)}"
        yield " ".join(copy)


@pytest.mark.parametrize("percent", [80, 85])
def test_components_against_brute_force(spark, percent):
    """Families larger than a short list, with links just above and below the limit, passages in common, copies, and short texts."""
    r = random.Random(percent)
    texts = [t for size, words, edits in ((60, 200, 6), (40, 120, 5), (30, 60, 2), (25, 300, 16), (8, 90, 3)) for t in family(r, size, words, edits)]
    passage = " ".join(f"p{i}" for i in range(70))
    texts += [passage + " " + " ".join(f"q{r.randint(0, 10 ** 6)}" for _ in range(r.randint(5, 60))) for _ in range(60)]
    texts += ["a b", "A b", "a  b\n", "a b c d e f", "a b c d e f g", None, "", *texts[:5], *texts[200:220]]
    r.shuffle(texts)
    docs = dict(enumerate(texts))
    rows = near_dedup.near_duplicates(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), percent=percent).collect()
    want = brute_components(docs, percent)
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in rows} == want
    assert all(x.kept == (x.doc_id == x.component_id) for x in rows)


def test_one_document_of_each_group_stays(spark, odd):
    rows = near_dedup.one_of_each(odd)
    assert sorted(x.doc_id for x in rows.collect()) == [0, 1, 2, 3, 4, 7, 9, 10]
    assert rows.filter(F.col("doc_id") == 4).first().lang == "en"


def test_one_id_with_different_texts(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    docs = spark.createDataFrame([(1, a), (1, b), (2, a + " more"), (3, b + " more"), (9, "c d e f g h"), (7, "c d e f g h")], "doc_id long, text string")
    got = sorted((x.doc_id, x.component_id, x.kept) for x in near_dedup.near_duplicates(docs).collect())
    assert got == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (7, 7, True), (9, 7, False)]
    assert sorted(x.doc_id for x in near_dedup.one_of_each(docs).collect()) == [1, 1, 7]


def test_rows_without_an_id(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(None, a), (None, a), (None, a + " more"), (4, a.upper()), (None, b), (None, b), (None, b + " more"), (None, b.upper()), (None, None), (None, " "), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = [(x.doc_id, x.text) for x in near_dedup.one_of_each(docs).collect()]
    assert [t for i, t in left if i] == [a.upper()] and len([t for i, t in left if not i and (t or "").strip()]) == 1 and len(left) == 5
    got = near_dedup.near_duplicates(docs).collect()
    assert {x.component_id for x in got} == {None, 4} and sum(x.component_id == 4 for x in got) == 4
    with pytest.raises(TypeError, match="doc_id is of type string"):
        near_dedup.near_duplicates(docs.withColumn("doc_id", F.col("doc_id").cast("string")))


def test_pairs_cross_components_only(spark):
    lists = spark.createDataFrame([(1, i, 100, 100, 20) for i in range(6)] + [(1, 6, 100, 80, 20)], "value long, id long, n long, reach long, m long")
    labels = spark.createDataFrame([(1, 0), (2, 0), (3, 0), (0, 0)], "node long, label long")
    got = {(x.a, x.b) for x in near_dedup.crossing_pairs(lists, labels, 85).collect()}
    assert got == {(a, b) for a in range(4) for b in (4, 5)} | {(4, 5)}


@pytest.mark.parametrize("small, large", [(64, 80), (80, 100), (100, 125), (120, 150)])
def test_contained_pairs_at_the_limit_are_linked(spark, small, large):
    """Sketches that reach past half of the hash range, of sets of unequal size."""
    r = random.Random(small)
    words = [[f"w{r.randint(0, 10 ** 9)}" for _ in range(large + 4)] for _ in range(60)]
    docs = [(2 * i + j, " ".join(w[:n + 4])) for i, w in enumerate(words) for j, n in enumerate((small, large))]
    rows = near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), percent=80).collect()
    assert {x.doc_id: x.component_id for x in rows} == {i: i - i % 2 for i, _ in docs}


def test_share_of_a_sketch_follows_the_limit():
    tail = lambda t, c: sum(math.comb(64, i) * t ** i * (1 - t) ** (64 - i) for i in range(c))
    assert near_dedup.share_of(85) == 60
    for percent in (70, 80, 85, 90):
        least = -(-near_dedup.share_of(percent) * 64 // 100)
        assert tail(percent / 100, least) < 1e-6 <= tail(percent / 100, least + 1)
