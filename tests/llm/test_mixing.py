"""Mixing of sources against literal apportionment, and its edge cases."""

import heapq
import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from terrace.llm import source_mixing
from terrace.llm.common import documents


def literal_targets(sizes):
    """Targets by source: shared by weight, what is above three times a source's size shared again, until nothing is."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(3 * sizes[s] for s in capped)
        target = {s: 3 * sizes[s] if s in capped else rest * weight[s] / sum(weight[x] for x in free) for s in names}
        above = {s for s in free if target[s] >= 3 * sizes[s]}
        if not any(target[s] > 3 * sizes[s] for s in free):
            return target
        capped |= above


def literal_seats(shares, seats):
    """Seat by seat to the highest quotient; of equal ones to the smaller party."""
    won = dict.fromkeys(shares, 0)
    heap = [(-s, p) for p, s in shares.items()]
    heapq.heapify(heap)
    for _ in range(seats):
        _, p = heapq.heappop(heap)
        won[p] += 1
        heapq.heappush(heap, (-shares[p] / (2 * won[p] + 1), p))
    return won


def n_words(text):
    return len((text or "").encode().split())


@pytest.mark.parametrize("shares, seats", [([5.0, 5.0, 5.0, 5.0], 6), ([1000.0, 1.0, 2.0, 3.5, 0.1], 37), ([3.0] * 50 + [1.0] * 50, 20), ([7.0], 9), ([1.0, 2.0], 0), ([10.0, 4.0, 4.0, 4.0, 2.0] * 30, 151)])
def test_apportionment(spark, shares, seats):
    rows = [(g, i, s * (1 + g)) for g in (0, 1) for i, s in enumerate(shares)]
    parties = spark.createDataFrame(rows, "g int, p int, share double")
    groups = spark.createDataFrame([(0, seats), (1, seats + 1)], "g int, seats long")
    got = {(r.g, r.p): r.quota for r in source_mixing.apportion(parties, groups, ["g"], "p", "test").collect()}
    for g in (0, 1):
        assert {p: got[g, p] for p in range(len(shares))} == literal_seats({i: s * (1 + g) for i, s in enumerate(shares)}, seats + g)


def test_rows_are_numbered_in_order(spark):
    rows = spark.range(1000).select(F.xxhash64("id").alias("h"), F.when(F.col("id") % 7 > 0, F.col("id") % 3).alias("g")).repartition(5)
    got = sorted((r.place, r.g is not None, r.g or 0, r.h) for r in source_mixing.numbered(rows, [F.asc("g"), F.asc("h")], "test").collect())
    assert [x[0] for x in got] == list(range(1000)) and [x[1:] for x in got] == sorted(x[1:] for x in got)


def check_mix(rows, most_times=3, near=0.01):
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
    want = literal_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-12)
        spans = [(s["first"], s["last"]) for s in r.spans]
        assert all(0 <= a <= b < r.size for a, b in spans) and all(b + 1 < c for (_, b), (c, _) in zip(spans, spans[1:]))
        n = r.passes * r.size + sum(b - a + 1 for a, b in spans)
        assert 0 <= n <= most_times * r.size
        taken[r.source] += n
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(near * t, 3 * rows[0].block_words), s
    return taken


@pytest.mark.parametrize("shard_words", [source_mixing.SHARD_WORDS, 3000])
def test_mix_of_documents(spark, sf_dir, texts, shard_words):
    rows = source_mixing.mix_sources(documents(spark, sf_dir), shard_words=shard_words).collect()
    assert {r.doc_id: r.size for r in rows} == {k: n_words(t) for k, t in texts.items()}
    check_mix(rows)


def test_hot_tiny_empty_and_nameless_sources(spark):
    sizes = {"a": [400] * 60 + [30_000], "b": [3, 4], "c": [0, 0], "d": [50] * 20, "é": [1], None: [700, 20]}
    docs = spark.createDataFrame([(i, " ".join(["w"] * n) if n else None, s) for s, ns in sizes.items() for i, n in enumerate(ns)], "doc_id long, text string, source string")
    rows = source_mixing.mix_sources(docs, shard_words=5000).collect()
    taken = check_mix(rows)
    assert taken["c"] == 0 and taken["é"] == 3 and taken["b"] == 21 and rows[0].block_words == 1


def test_seeds_and_reruns(spark, sf_dir):
    docs = documents(spark, sf_dir)
    digest = lambda d, **o: sorted(map(str, source_mixing.mix_sources(d, **o).collect()))
    one = digest(docs)
    assert one == digest(docs.repartition(7)) and one != digest(docs, seed=1)
    check_mix(source_mixing.mix_sources(docs, seed=1).collect())


def test_chosen_words_are_whole_blocks(spark):
    """In one shard the spans are exactly the blocks with the lowest hashes."""
    docs = spark.createDataFrame([(i, " ".join(["w"] * (7 + i % 11)), "ab"[i % 2]) for i in range(400)], "doc_id long, text string, source string")
    rows = source_mixing.mix_sources(docs).collect()
    block = rows[0].block_words
    for s in "ab":
        extra = sum(b["last"] - b["first"] + 1 for r in rows if r.source == s for b in r.spans)
        target, size = next((r.target, r.source_size) for r in rows if r.source == s)
        assert abs(extra - (target - size * (target // size))) <= 2 * block
