"""Byte-level BPE encoding and decoding by a sentencepiece model that is serialised directly from the vocabulary.

Every byte is mapped to one printable character, so a token of any bytes is a piece of text. A piece's score is its negative
rank: the best-scored merge is then the one of least rank, the leftmost first, which is the order of a rank-based byte BPE.
Normalisation is the identity. Each pre-token is encoded on its own; decoding maps ids back to pieces and pieces to bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import byte_slices

SLICE_BYTES = 1 << 20
REMEMBERED_PRE_TOKENS = 1 << 19
LONGEST_REMEMBERED = 40


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it is printable Latin-1, else the next one from code point 256."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a file of base64 tokens and ranks, by rank."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    return [ranks[i] for i in range(len(ranks))]


def _varint(value: int) -> bytes:
    out = b""
    while value > 0x7F:
        out += bytes([value & 0x7F | 0x80])
        value >>= 7
    return out + bytes([value])


def _field(number: int, value: bytes | int) -> bytes:
    """One field of a protocol buffer message: an integer, or bytes with their length in front."""
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def model_bytes(tokens: list[bytes]) -> bytes:
    """A serialised sentencepiece model whose piece i is token i, byte-mapped, with score -i; an unused unknown piece ends it."""
    # Field numbers and enum values of the public sentencepiece model format.
    pieces, trainer, normaliser = 1, 2, 3
    text, score, kind, unknown = 1, 2, 3, 2
    model_type, vocab_size, bpe = 3, 4, 2
    name, dummy_prefix, trim_white_space, escape_white_space = 1, 3, 4, 5
    out, letters = [], byte_characters()
    for rank, token in enumerate(tokens):
        piece = "".join(letters[b] for b in token).encode()
        out.append(_field(pieces, _field(text, piece) + _varint(score << 3 | 5) + struct.pack("<f", -rank)))
    out.append(_field(pieces, _field(text, "⁇".encode()) + _varint(score << 3 | 5) + struct.pack("<f", 0) + _field(kind, unknown)))
    out.append(_field(trainer, _field(model_type, bpe) + _field(vocab_size, len(tokens) + 1)))
    out.append(_field(normaliser, _field(name, b"identity") + _field(dummy_prefix, 0) + _field(trim_white_space, 0) + _field(escape_white_space, 0)))
    return b"".join(out)


class ByteBpe:
    """Encoder and decoder over one file of ranks and one pre-token pattern."""

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        self.tokens = read_ranks(path)
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(self.tokens))
        self.pre_tokens = regex.compile(pattern)
        self.mapped = dict(enumerate(byte_characters()))
        self.decimal = [str(i) for i in range(len(self.tokens))]
        self.known: dict[str, bytes] = {}  # ids of a pre-token as 32-bit integers

    def encode_new(self, pre_tokens: set[str]) -> dict[str, bytes]:
        order = list(pre_tokens)
        texts = [x.encode().decode("latin-1").translate(self.mapped) for x in order]
        ids = self.processor.encode(texts, num_threads=1)
        return {x: np.array(found, np.int32).tobytes() for x, found in zip(order, ids, strict=True)}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [self.pre_tokens.findall(text) for text in texts]
        new = set().union(*cut).difference(self.known)
        if len(self.known) + len(new) > REMEMBERED_PRE_TOKENS:
            self.known.clear()
            new = set().union(*cut)
        self.known.update(self.encode_new(new))
        out = [np.frombuffer(b"".join(map(self.known.__getitem__, found)), np.int32) for found in cut]
        for x in new:
            if len(x) > LONGEST_REMEMBERED:
                del self.known[x]
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


_CODECS: dict[tuple[str, str], ByteBpe] = {}


def codec(path: str, pattern: str) -> ByteBpe:
    """One per worker process, file and pattern."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = ByteBpe(path, pattern)
    return _CODECS[path, pattern]


def encode(docs: DataFrame, ranks: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Return id and ids (array of int) for every row.

    A null text counts as empty and has no ids. Repeated rows give repeated rows; an empty table gives an empty one; other columns
    are ignored. No special tokens: their strings in a text are ordinary text.
    """
    id_type = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(ranks, pattern)
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                ids = bpe.encode([text or "" for text in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(ids, pa.list_(pa.int32()))], names=["id", "ids"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(run, f"id {id_type}, ids array<int>").withColumnRenamed("id", id_column)


def decode(encoded: DataFrame, ranks: str, pattern: str, id_column: str = "doc_id") -> DataFrame:
    """Return id and bytes (binary) for every row of id and ids; null ids decode to no bytes."""
    id_type = encoded.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(ranks, pattern)
        for batch in batches:
            out = [bpe.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.binary())], names=["id", "bytes"])

    rows = encoded.select(F.col(id_column).alias("id"), "ids")
    return rows.mapInArrow(run, f"id {id_type}, bytes binary").withColumnRenamed("id", id_column)


def round_trip_digests(docs: DataFrame, ranks: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Return id, n_tokens, and SHA-256 of the decimal ids (joined by one space) and of the bytes decoded from them.

    Nulls, empty tables, repeated rows and other columns as in `encode`. Encoding, decoding and digests happen in one pass, so that
    ids never leave the task.
    """
    id_type = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(ranks, pattern)
        digest = lambda data: hashlib.sha256(data).hexdigest()
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                rows = [ids.tolist() for ids in bpe.encode([text or "" for text in part.column("text").to_pylist()])]
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), pa.array([len(ids) for ids in rows], pa.int64()),
                    pa.array([digest(" ".join(map(bpe.decimal.__getitem__, ids)).encode()) for ids in rows]),
                    pa.array([digest(bpe.decode(ids)) for ids in rows]),
                ], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(run, f"id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_column)
