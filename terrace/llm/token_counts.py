"""Token counts: batch encoding in Arrow functions that return lengths only.

Batches hold about the same number of bytes, whatever the lengths of the texts. Texts are cut at safe boundaries (before white
space that follows something else), every distinct piece of a batch is encoded once by the tokenizer itself, and lengths add up.
A worker remembers the lengths of short pieces in a table of bounded size.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import SAFE_PIECE, byte_slices

SLICE_BYTES = 1 << 20
REMEMBERED_PIECES = 1 << 20
LONGEST_REMEMBERED = 40


class PieceLengths:
    """Number of tokens of texts under one tokenizer file."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[str, int] = {}

    def encode_new(self, pieces: set[str]) -> dict[str, int]:
        order = list(pieces)
        return dict(zip(order, map(len, self.tokenizer.encode_batch_fast(order, add_special_tokens=False)), strict=True))

    def counts(self, texts: list[str]) -> list[int]:
        cut = [SAFE_PIECE.findall(text) for text in texts]
        new = set().union(*cut).difference(self.known)
        if len(self.known) + len(new) > REMEMBERED_PIECES:
            self.known.clear()
            new = set().union(*cut)
        self.known.update(self.encode_new(new))
        out = [sum(map(self.known.__getitem__, pieces)) for pieces in cut]
        for piece in new:
            if len(piece) > LONGEST_REMEMBERED:
                del self.known[piece]
        return out


_LENGTHS: dict[str, PieceLengths] = {}


def lengths_of(path: str) -> PieceLengths:
    """One per worker process and file."""
    if path not in _LENGTHS:
        _LENGTHS[path] = PieceLengths(path)
    return _LENGTHS[path]


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Return id, n_bytes, n_tokens and over_limit (n_tokens > limit) for every row.

    A null text counts as empty: 0 bytes, 0 tokens. Repeated rows give repeated rows; an empty table gives an empty one; other
    columns of the input are ignored, whatever their names. The tokenizer's special strings inside a text are single tokens,
    as by its own default; no text is truncated.
    """
    id_type = docs.schema[id_column].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = lengths_of(tokenizer)
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                n_tokens = lengths.counts([text or "" for text in part.column("text").to_pylist()])
                n_bytes = pc.fill_null(pc.binary_length(part.column("text")), 0).cast(pa.int64())
                tokens = pa.array(n_tokens, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("id"), n_bytes, tokens, pc.greater(tokens, limit)],
                                                 names=["id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(count, f"id {id_type}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("id", id_column)
