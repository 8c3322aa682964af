"""Periodic runs against brute force."""

import hashlib
import random
import zlib
from fractions import Fraction

import pytest

from terrace.llm import periodic_runs
from terrace.llm.common import documents


def brute_runs(words):
    out, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q) and not any(words[i:i + length - r] == words[i + r:i + length] for r in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def random_documents(r):
    docs = []
    for _ in range(r.randint(1, 6)):
        n, letters = r.choice([0, 1, 3, 6, 10, 30, 80]), r.choice([1, 2, 3, 5])
        words = [bytes([97 + r.randrange(letters)]) for _ in range(n)]
        if n and r.random() < 0.7:
            p, a = r.randint(1, max(1, n // 4)), r.randrange(n)
            words = words[:a] + [words[min(a + i % p, n - 1)] for i in range(n - a)]
        words *= r.randint(1, 4) if r.random() < 0.3 else 1
        docs.append(docs[-1] + words if docs and r.random() < 0.3 else words)
    return docs


def test_random_words_against_brute_force():
    r = random.Random(12)
    for _ in range(800):
        docs = random_documents(r)
        assert periodic_runs.runs_of(docs) == [brute_runs(d) for d in docs]


def test_grammar_derives_its_text():
    import numpy as np

    r = random.Random(5)
    for n in (1, 2, 3, 50, 400):
        ids = np.array([r.randrange(3) for _ in range(n)] + [3])
        g = periodic_runs.Grammar(ids, 4)
        expand = lambda s: [s] if s < 4 else expand(g.left[s - 4]) + expand(g.right[s - 4])  # noqa: E731, B023
        assert [x for s in g.sequence for x in expand(s)] == ids.tolist()
        pairs = [(a, b) for a, b in zip(g.sequence, g.sequence[1:])]
        assert all(pairs.count(p) <= (1 if p[0] != p[1] else 2) for p in pairs)
        for i in range(len(g.left)):
            assert expand(4 + i) == ids[g.first[i]:g.end[i]].tolist() and expand(g.left[i]) == ids[g.first[i]:g.middle[i]].tolist()


def edited(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def digests(words, runs):
    sha = lambda s: hashlib.sha256(s).hexdigest()
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    return (len(runs), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4), sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()),
            sha(b" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_documents_against_brute_force(spark, sf_dir, texts):
    got = {r.doc_id: tuple(r)[1:] for r in periodic_runs.run_digests(documents(spark, sf_dir)).collect()}
    assert set(got) == set(texts)
    long = 0
    for k, text in texts.items():
        words = edited(k, (text or "").encode().split())
        if len(words) <= 1500:
            assert got[k] == digests(words, brute_runs(words)), k
        long += len(words) > 1500
    assert long < 0.1 * len(texts) and sum(v[0] > 0 for v in got.values()) > 0.05 * len(got)


@pytest.mark.parametrize("n, p", [(20_000, 1), (20_000, 7), (20_000, 4999)])
def test_long_periods(n, p):
    r = random.Random(p)
    root = [b"%d" % r.randrange(10 ** 6) for _ in range(p)]
    words = [b"x"] + [root[i % p] for i in range(n)] + [b"y"]
    assert periodic_runs.runs_of([words, words[:-1]]) == [[(1, n, p)]] * 2


def test_runs_and_collapsed_text(spark):
    docs = spark.createDataFrame([(1, "so buy now buy now buy now buy now end"), (2, "a a a a a"), (3, None), (4, "a a\na\ta a  a "), (None, "b b b b b b b")], "doc_id long, text string")
    rows = {r.doc_id: r for r in periodic_runs.periodic_runs(docs).collect()}
    assert [tuple(x) for x in rows[1].runs] == [(1, 8, 2)] and rows[1].collapsed == "so buy now end"
    assert rows[2].runs == [] and rows[3].collapsed == "" and rows[4].collapsed == "a" and [tuple(x) for x in rows[None].runs] == [(0, 7, 1)]
