"""Language ID by hyperdimensional profiles.

Every letter has a random vector of +1 and -1 that follows from its code point. The vectors of an n-gram's letters are shifted by
their places and multiplied (bound) into the n-gram's vector; the vectors of all n-grams of a text are added (bundled) into its
profile. A language's prototype is the sum of the profiles of its texts. A text takes the language whose prototype has the
largest cosine with its profile.

Profiles are sums of integers, so they don't depend on how texts are dealt out. In a task the n-grams of a slice of texts are
counted first and each distinct n-gram is bound once; the bundle is then a product of two matrices of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import byte_slices

DIMENSIONS, LETTERS = 1024, 3
SLICE_BYTES = 1 << 21
MOST_DOCS, MOST_GRAMS = 512, 8192  # of one matrix product
GAP = 32


@cache
def _letter_table() -> np.ndarray:
    """By code point: the lower-case letter, or GAP for anything else."""
    table = np.full(0x110000, GAP, np.int32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            table[i] = ord(low) if len(low := c.lower()) == 1 else i
    return table


_VECTORS: dict[int, np.ndarray] = {}


def _vectors(letters: np.ndarray) -> np.ndarray:
    if len(_VECTORS) > 20_000:
        _VECTORS.clear()
    for c in letters.tolist():
        if c not in _VECTORS:
            bits = np.random.Generator(np.random.Philox(key=c)).integers(0, 2, DIMENSIONS, np.int8)
            _VECTORS[c] = 2 * bits - 1
    return np.stack([_VECTORS[c] for c in letters.tolist()])


def profiles(texts: list[str | None]) -> np.ndarray:
    """One profile per text, as integers; zeros for a text without a letter."""
    out = np.zeros((len(texts), DIMENSIONS), np.int64)
    whole = "".join(f" {text or ''} " for text in texts)
    if not whole.strip():
        return out
    letters = _letter_table()[np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)]
    doc = np.repeat(np.arange(len(texts)), [len(text or "") + 2 for text in texts])
    keep = np.ones(len(letters), bool)  # one gap between words
    keep[1:] = (letters[1:] != GAP) | (letters[:-1] != GAP) | (doc[1:] != doc[:-1])
    letters, doc = letters[keep], doc[keep]
    known, place = np.unique(letters, return_inverse=True)
    starts = np.flatnonzero(doc[LETTERS - 1:] == doc[:len(doc) - LETTERS + 1])
    if not len(starts):
        return out
    size, codes = len(known), np.zeros(len(starts), np.int64)
    for j in range(LETTERS):
        codes = codes * size + place[starts + j]
    if size ** LETTERS <= 1 << 24:
        seen = np.zeros(size ** LETTERS, bool)
        seen[codes] = True
        grams, number = np.flatnonzero(seen), np.cumsum(seen) - 1
        gram = number[codes]
    else:
        grams, gram = np.unique(codes, return_inverse=True)
    doc, letter_vectors = doc[starts], _vectors(known)
    for low in range(0, len(grams), MOST_GRAMS):
        some = grams[low:low + MOST_GRAMS]
        bound = np.ones((len(some), DIMENSIONS), np.int8)
        for j in range(LETTERS):
            bound *= np.roll(letter_vectors, j, axis=1)[some // size ** (LETTERS - 1 - j) % size]
        bound = bound.astype(np.float32)
        here = slice(None) if len(grams) <= MOST_GRAMS else (gram >= low) & (gram < low + MOST_GRAMS)
        docs_here, grams_here = doc[here], gram[here] - low
        edges = np.searchsorted(docs_here, range(0, len(texts) + MOST_DOCS, MOST_DOCS))
        for k in range(len(edges) - 1):
            a, b = edges[k], edges[k + 1]
            first, n = k * MOST_DOCS, min(MOST_DOCS, len(texts) - k * MOST_DOCS)
            if b > a:
                counts = np.bincount((docs_here[a:b] - first) * len(some) + grams_here[a:b], minlength=n * len(some)).reshape(n, -1)
                exact = bound if counts.sum(axis=1).max() < 1 << 24 else bound.astype(np.float64)  # float32 holds smaller integers exactly
                out[first:first + n] += np.rint(counts.astype(exact.dtype) @ exact).astype(np.int64)
    return out



def learn(docs: DataFrame, text_column: str = "text", lang_column: str = "lang") -> dict[str, np.ndarray]:
    """A prototype per language from rows with a text and a language.

    Each task sends one vector per language it has met and Spark adds them up. What reaches the driver is one vector per language.
    """
    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                rows, langs = profiles(part.column("text").to_pylist()), np.array(part.column("lang").to_pylist())
                for lang in set(langs.tolist()):
                    sums[lang] = sums.get(lang, 0) + rows[langs == lang].sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(sums.keys(), pa.string()), pa.array(list(sums.values()), pa.list_(pa.int64()))], names=["lang", "sums"])

    rows = docs.select(F.col(text_column).alias("text"), F.col(lang_column).alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")
    sums = rows.mapInArrow(bundle, "lang string, sums array<long>").select("lang", F.posexplode("sums").alias("at", "value"))
    totals = sums.groupBy("lang", "at").agg(F.sum("value").alias("value")).groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("at", "value")))["value"].alias("sums"))
    found = {r["lang"]: np.array(r["sums"], np.float64) for r in totals.collect()}
    return {lang: v for lang, v in sorted(found.items()) if v.any()}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Return id, lang_pred and score (the cosine, 0 at least) for every row.

    A text that is null or has no letter is `und` with score 0, and so is every text if there are no prototypes. Between equal
    cosines the first language by name wins. Other columns are ignored; repeated rows give repeated rows.
    """
    id_type = docs.schema[id_column].dataType.simpleString()
    names = sorted(prototypes)
    units = np.stack([prototypes[n] / np.linalg.norm(prototypes[n]) for n in names]) if names else None

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                rows = profiles(part.column("text").to_pylist()).astype(np.float64)
                norm = np.linalg.norm(rows, axis=1)
                if units is None:
                    langs, scores = ["und"] * len(rows), np.zeros(len(rows))
                else:
                    cosines = rows @ units.T / np.where(norm, norm, 1)[:, None]
                    best = cosines.argmax(axis=1)
                    langs = [names[k] if n else "und" for k, n in zip(best, norm, strict=True)]
                    scores = np.where(norm > 0, np.clip(cosines[np.arange(len(rows)), best], 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["id", "lang_pred", "score"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(compare, f"id {id_type}, lang_pred string, score double").withColumnRenamed("id", id_column)


def is_held_out(id_column: str = "doc_id") -> Column:
    """Whether a row is kept from learning: CRC-32 of the id as text leaves 2 modulo 4. A null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def language_id(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """Learn from the rows that aren't held out and predict every row: id, held_out, lang_pred and score."""
    prototypes = learn(docs.filter(~is_held_out(id_column)), text_column, lang_column)
    return predict(docs, prototypes, id_column, text_column).withColumn("held_out", is_held_out(id_column)).select(id_column, "held_out", "lang_pred", "score")
