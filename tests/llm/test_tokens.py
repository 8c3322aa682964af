"""Token counts, byte-level BPE and packing against the tokenizers' own libraries."""

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from terrace.llm import packing
from terrace.llm.byte_bpe import ByteBpe, decode, encode, round_trip_digests
from terrace.llm.common import documents
from terrace.llm.packing import PieceIds, best_fit, pack, pack_counts, pack_documents, reduce_instance
from terrace.llm.token_counts import PieceLengths, token_counts

BPE, RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
LETTERS = [*"ab 1!\n\t  ' \x1c\x1f\x85\xa0　é中<|endoftext|>\x00", "<|endoftext|>", "'s", " 's", "​", "﻿", "😀", "ͅ", "²", "\r\n", "  \n"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(BPE)


@pytest.fixture(scope="module")
def by_rank():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def random_texts(n):
    r = random.Random(11)
    return ["".join(r.choice(LETTERS) for _ in range(r.randint(0, 30))) for _ in range(n)]


def test_counts_of_odd_texts(tokenizer):
    lengths, texts = PieceLengths(BPE), random_texts(4000)
    assert lengths.counts(texts) == [len(e) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_counts_of_documents(spark, sf_dir, texts, tokenizer):
    got = {r.doc_id: r for r in token_counts(documents(spark, sf_dir), BPE).collect()}
    want = dict(zip(texts, tokenizer.encode_batch(list(texts.values()), add_special_tokens=False), strict=True))
    assert {k: (r.n_bytes, r.n_tokens, r.over_limit) for k, r in got.items()} == {k: (len(texts[k].encode()), len(e), len(e) > 1024) for k, e in want.items()}


def test_model_from_the_vocabulary(by_rank):
    bpe, texts = ByteBpe(RANKS, PATTERN), random_texts(4000) + ["a" * 30_000 + "é" * 500]
    for text, ids in zip(texts, bpe.encode(texts), strict=True):
        assert ids.tolist() == by_rank.encode_ordinary(text) and bpe.decode(ids.tolist()) == text.encode()
    tokens = [t.decode() for t in bpe.tokens if t.decode(errors="replace").encode() == t]
    assert [x.tolist() for x in bpe.encode(tokens)] == [by_rank.encode_ordinary(t) for t in tokens]


def test_round_trip(spark, sf_dir, texts, by_rank):
    docs = documents(spark, sf_dir)
    for r in round_trip_digests(docs, RANKS, PATTERN).collect():
        ids, digest = by_rank.encode_ordinary(texts[r.doc_id]), lambda b: hashlib.sha256(b).hexdigest()
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), digest(" ".join(map(str, ids)).encode()), digest(texts[r.doc_id].encode()))
    assert {r.doc_id: bytes(r["bytes"]).decode() for r in decode(encode(docs, RANKS, PATTERN), RANKS, PATTERN).collect()} == texts


def test_ids_of_odd_texts(tokenizer):
    ids, texts = PieceIds(BPE, PATTERN), random_texts(4000)
    for got, want in zip(ids.encode(texts), tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == want.ids


def test_plain_pieces_make_no_array_each(monkeypatch, tokenizer):
    ids, texts, made = PieceIds(BPE, PATTERN), ["some plain words, naïve ones too", "", "odd 中文 ones <|endoftext|> ones"], []
    monkeypatch.setattr(packing.np, "array", lambda *a, f=np.array: made.append(a) or f(*a))
    got = ids.encode(texts)
    assert len(made) == 2  # one for each odd piece
    for one, want in zip(got, tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(one, "<u4").tolist() == want.ids


def check_packing(rows, capacity):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for held in by_sequence.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_packed_documents(spark, sf_dir, texts, tokenizer):
    rows = pack_documents(documents(spark, sf_dir), BPE, PATTERN).collect()
    assert check_packing(rows, 2048) <= 1 - (-sum(r.length for r in rows) // 2048)
    of = defaultdict(list)
    for r in rows:
        of[r.doc_id].append(r)
    assert set(of) == set(texts)
    for doc, text in texts.items():
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [0]
        pieces, at = sorted(of[doc], key=lambda r: r.piece), 0
        assert [r.piece for r in pieces] == list(range(len(pieces))) and all(r.length == 2048 for r in pieces[1:])
        for r in pieces:
            assert r.start == at and r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids) and (len(pieces) > 1) == (len(ids) > 2048)


def smallest_number(items, capacity):
    best = [len(items)]

    def place(i, used):
        if len(used) >= best[0]:
            return
        if i == len(items):
            best[0] = len(used)
            return
        for j in {u: j for j, u in enumerate(used)}.values():
            if used[j] + items[i] <= capacity:
                used[j] += items[i]
                place(i + 1, used)
                used[j] -= items[i]
        used.append(items[i])
        place(i + 1, used)
        used.pop()

    place(0, [])
    return best[0]


def test_reduction_never_costs_a_sequence():
    r = random.Random(5)
    for _ in range(1500):
        capacity = r.randint(5, 20)
        items = sorted((r.randint(1, capacity) for _ in range(r.randint(1, 9))), reverse=True)
        fixed, left = reduce_instance(Counter(items), capacity)
        rest = sorted((s for s, n in left.items() for _ in range(n)), reverse=True)
        assert sum(many for many, _ in fixed) + (smallest_number(rest, capacity) if rest else 0) == smallest_number(items, capacity)
        held = Counter()
        for many, sizes in pack_counts(Counter(items), capacity):
            assert sum(s * n for s, n in sizes) <= capacity
            held.update({s: many * n for s, n in sizes})
        assert held == Counter(items)


def test_best_fit_is_best_fit():
    r = random.Random(9)
    for _ in range(300):
        capacity = r.randint(5, 30)
        items = sorted((r.randint(1, capacity) for _ in range(r.randint(1, 40))), reverse=True)
        free = []
        for size in items:
            fits = [f for f in free if f >= size]
            if fits:
                free.remove(min(fits))
            free.append((min(fits) if fits else capacity) - size)
        assert sum(many for many, _ in best_fit(Counter(items), capacity)) == len(free)


def test_pack_any_rows(spark):
    rows = spark.createDataFrame([("a", 3), ("a", 3), ("b", 7), ("c", 10), ("d", 1)], "name string, length int")
    assert check_packing(pack(rows, 10).collect(), 10) == 3
    with pytest.raises(Exception, match="fits into no sequence"):
        pack(spark.createDataFrame([("a", 11)], "name string, length int"), 10).collect()
