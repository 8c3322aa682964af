"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest

from terrace.llm import spelling
from terrace.llm.common import documents


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a != b and (a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:])


def brute_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in word)
            h = zlib.crc32(f"{doc_id}:{word}".encode())
            if h % 199 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def brute_variants(words):
    by_rest = {}
    for w in words:  # words with one code point left out meet those one edit away
        for i in range(len(w)):
            by_rest.setdefault(w[:i] + w[i + 1:], set()).add(w)
    near = {w: {x for i in range(len(w)) for x in by_rest[w[:i] + w[i + 1:]] if one_apart(w, x)} | {x for x in by_rest.get(w, ()) if one_apart(w, x)}
            | {w[:i] + w[i + 1:] for i in range(len(w)) if w[:i] + w[i + 1:] in words} for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return {w: (form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def values(rows):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_scan_against_brute_force():
    r = random.Random(13)
    for _ in range(1500):
        letters, most = "abc"[:r.randint(1, 3)], r.choice([2, 4, 7])
        words = sorted({"".join(r.choice(letters) for _ in range(r.randint(0, most))) for _ in range(r.randint(0, 40))})
        assert sorted(spelling.near_in_order(words)) == [(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if i < j and one_apart(a, b)]


def test_documents_against_brute_force(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    want = brute_variants(brute_words([(r.doc_id, r.text) for r in docs.collect()]))
    got = values(spelling.spelling_variants(docs, spelling.one_left_out).collect())
    assert got == want and sum(f is not None for f, *_ in got.values()) > 20


@pytest.mark.parametrize("most", [2, 10, 2000])
def test_lists_dealt_again_lose_no_pair(spark, most):
    """A dense vocabulary, all of it with one head or one tail, in lists that are halved until they are short."""
    r = random.Random(most)
    words = {"stem" + "".join(r.choice("abé") for _ in range(r.randint(2, 5))): r.randint(5, 10 ** 4) for _ in range(250)}
    words |= {"".join(r.choice("abé") for _ in range(r.randint(3, 5))) + "tail": r.randint(5, 10 ** 4) for _ in range(150)}
    words |= {"aaaaaa": 9, "aaaaaaa": 900, "aaaaaaaa": 9, "q" * 3000: 8, "q" * 3001: 80}
    pairs = [(x.word, x.near) for x in spelling.near_words(spark.createDataFrame(list(words.items()), "word string, n long"), 6, most).collect()]
    assert sorted(pairs) == sorted((a, b) for a in words for b in words if one_apart(a, b))


def test_forms_roots_and_ties(spark):
    text = "receive " * 625 + "recieve " * 5 + "receve " * 25 + "recevee " * 5 + "Straße " * 9 + "coloured " * 5 + "coloureds " * 25 + "xcoloured " * 25 + "shorts " * 4
    docs = spark.createDataFrame([(1, text), (2, None), (None, ""), (3, "a1b2 ___")], "doc_id long, text string")
    got = values(spelling.spelling_variants(docs).collect())
    assert got["receve"] == ("receive", "receive", 25, 3, 625) and got["recevee"] == ("receve", "receive", 5, 1, 25) and got["recieve"] == ("receve", "receive", 5, 1, 25)
    assert got["coloured"] == ("coloureds", "coloureds", 5, 2, 25) and got["straße"] == (None, "straße", 9, 0, None) and "shorts" not in got


def test_odd_rows_and_empty_tables(odd, clashing, empty, nameless):
    rows = lambda d: sorted(map(str, spelling.spelling_variants(d, spelling.one_left_out, least_count=2).collect()))
    assert rows(odd) == rows(clashing) != [] and rows(empty) == rows(nameless) == []
