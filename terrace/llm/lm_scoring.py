"""Stupid-backoff scores of documents from the bigram and word counts of the corpus itself.

Words are lower-cased (A-Z) runs of other characters than white space, known by a 64-bit hash of the whole word; n-grams by a 64-bit hash
of their words. Counts cover every n-gram of every document, without a limit on the vocabulary. A document is scored with the counts
of all others, its own taken off, so that no document vouches for itself: a bigram that others have scores count(a b) / count(a), any other backs off
to BACKOFF * count(b) / words, as if its word were seen once and backed off again where no other document has it. The first word of a document scores
count / words.

The steps are tables and joins:

* blocks: documents of a task, about BLOCK_WORDS words of them, as numbers of the block's distinct words (written once, read twice);
* n-grams: the block's distinct n-grams with their counts in it, exploded into buckets by hash. An n-gram comes at most once from a
  block, so the most common one is less than a 100,000th of all rows and needs no salt;
* count tables: the sums per n-gram, partitioned by bucket, joined back to the n-grams of the blocks in the bucket;
* scores: the totals of a block's n-grams, joined to the block and summed per document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import byte_slices, staged
from terrace.llm.near_dedup import _mix, _whole_number

BACKOFF = 0.4
SLICE_BYTES = 1 << 20
BLOCK_WORDS = 800_000
BUCKET_ENTRIES = 1_000_000
BLOCK_SCHEMA = "block long, ids array<long>, lengths array<int>, words binary, sequence binary"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: both follow ASCII only


def pack(values: np.ndarray, ascending: bool = False) -> bytes:
    """64-bit numbers as compressed byte planes; ascending ones by their differences, so that the planes of high bytes are mostly zero."""
    values = values.astype(np.uint64)
    if ascending:
        values = np.diff(values, prepend=np.uint64(0))
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T)
    return len(values).to_bytes(8, "little") + pa.Codec("zstd").compress(planes.tobytes(), asbytes=True)


def unpack(data: bytes, ascending: bool = False) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.Codec("zstd").decompress(data[8:], 8 * n, asbytes=True), np.uint8) if n else np.empty(0, np.uint8)
    values = np.ascontiguousarray(planes.reshape(8, n).T).view(np.uint64).ravel()
    return np.cumsum(values, dtype=np.uint64) if ascending else values


def blocks(docs: DataFrame) -> DataFrame:
    """From id and text: block, ids, lengths (words of each document), words (sorted hashes) and sequence (places among them, compressed)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        number = TaskContext.get().partitionId() << 24  # the same in a task that runs again
        known: dict[bytes, int] = {}
        ids: list[int | None] = []
        lengths: list[int] = []
        parts: list[np.ndarray] = []

        def row() -> pa.RecordBatch:
            hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in known), np.uint64, len(known))
            words, places = np.unique(hashes, return_inverse=True)
            sequence = places.astype(np.int32)[np.concatenate(parts)] if parts else np.empty(0, np.int32)
            out = pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int32())), pa.array([pack(words, True)], pa.binary()),
                pa.array([pa.Codec("zstd").compress(sequence.tobytes(), asbytes=True)], pa.binary()),
            ], names=["block", "ids", "lengths", "words", "sequence"])
            for held in (known, ids, lengths, parts):
                held.clear()
            return out

        n = 0
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                for doc_id, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    words = words_of(text)
                    parts.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int32, len(words)))
                    ids.append(doc_id)
                    lengths.append(len(words))
                    n += len(words)
                    if n >= BLOCK_WORDS or len(ids) >= BLOCK_WORDS:
                        yield row()
                        number, n = number + 1, 0
        if ids:
            yield row()

    return docs.mapInArrow(run, BLOCK_SCHEMA)


class Block:
    """The n-grams of a block's documents."""

    def __init__(self, lengths: np.ndarray, words: np.ndarray, sequence: bytes):
        self.lengths = lengths
        n = int(lengths.sum())
        self.sequence = np.frombuffer(pa.Codec("zstd").decompress(sequence, 4 * n, asbytes=True), np.int32) if n else np.empty(0, np.int32)
        self.doc = np.repeat(np.arange(len(lengths)), lengths)
        self.inside = np.flatnonzero(self.doc[1:] == self.doc[:-1])  # places with a word of their document behind them
        first, second = words[self.sequence[self.inside]], words[self.sequence[self.inside + 1]]
        pairs = _mix(_mix(first) + second)
        # The block's n-grams in the order of their hashes, the place of each of its words among them, and that of each pair of words.
        self.keys, at = np.unique(np.concatenate([_mix(words + np.uint64(1)), pairs]), return_inverse=True)
        self.word, self.pair = at[:len(words)][self.sequence], at[len(words):]

    def counts(self) -> np.ndarray:
        return np.bincount(self.word, minlength=len(self.keys)) + np.bincount(self.pair, minlength=len(self.keys))

    def edges(self, buckets: int) -> np.ndarray:
        """Where the buckets lie among the keys: a bucket is a range of the keys' upper halves."""
        return np.searchsorted((self.keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32), np.arange(buckets + 1, dtype=np.uint64))

    def own(self, doc: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often an n-gram is in its own document."""
        _, which, counts = np.unique(doc * np.int64(len(self.keys)) + at, return_inverse=True, return_counts=True)
        return counts[which]

    def scores(self, totals: np.ndarray, total: int) -> np.ndarray:
        """Sums of logs per document."""
        others = np.maximum(total - self.lengths, 1)[self.doc]
        alone = (totals[self.word] - self.own(self.doc, self.word)).astype(float)
        unigram = np.log(np.where(alone > 0, alone, BACKOFF) / others)
        pair = totals[self.pair] - self.own(self.doc[self.inside], self.pair)
        logs = unigram.copy()  # the first word of a document
        with np.errstate(divide="ignore"):
            logs[self.inside + 1] = np.where(pair > 0, np.log(pair) - np.log(alone[self.inside]), np.log(BACKOFF) + unigram[self.inside + 1])
        return np.bincount(self.doc, logs, len(self.lengths))


def _block(row: dict) -> Block:
    return Block(row["lengths"], row["words"], row["sequence"])


def _rows(batch: pa.RecordBatch | pa.Table) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield {"block": batch.column("block")[i].as_py(), "ids": batch.column("ids")[i].values, "lengths": batch.column("lengths")[i].values.to_numpy(),
               "words": unpack(batch.column("words")[i].as_py(), True), "sequence": batch.column("sequence")[i].as_py()}


def ngrams(blocks: DataFrame, buckets: int) -> DataFrame:
    """bucket, block, keys and counts (packed) of each block's n-grams."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                block = _block(row)
                edges, counts = block.edges(buckets), block.counts()
                held = np.flatnonzero(edges[1:] > edges[:-1])
                slices = [slice(edges[b], edges[b + 1]) for b in held]
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array([row["block"]] * len(held), pa.int64()), pa.array([pack(block.keys[x], True) for x in slices], pa.binary()),
                                                  pa.array([pack(counts[x]) for x in slices], pa.binary())], names=["bucket", "block", "keys", "counts"])

    return blocks.mapInArrow(run, "bucket int, block long, keys binary, counts binary")


def joined_counts(table: pa.Table) -> pa.Table:
    """One bucket: its part of the count tables (an n-gram's sum over all blocks), joined to the n-grams of each block."""
    keys = [unpack(x, True) for x in table.column("keys").to_pylist()]
    counts = np.concatenate([unpack(x) for x in table.column("counts").to_pylist()])
    found, at = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(at, counts, len(found)).astype(np.uint64)[at]
    ends = np.cumsum([0, *map(len, keys)])
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "totals": pa.array([pack(totals[a:b]) for a, b in zip(ends, ends[1:])], pa.binary())})


def lm_scores(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Return id, n_words, log_score (sum of natural logs) and mean_log (log_score / n_words, null without words) for every id.

    Ids are whole numbers (another type is an error) and name documents: rows of one id, or of no id, are scored each for itself, and their scores added up. A copy of a document
    elsewhere counts as another one. A null text has no words; a document without words has log_score 0. In a corpus of one document nothing but backing off is left.
    An empty table gives an empty one. Other columns are ignored.
    """
    spark = docs.sparkSession
    id_type = _whole_number(docs, id_column)
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    held = staged(blocks(rows), "blocks")
    total = held.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n))).head()[0] or 0
    buckets = max(-(-total // BUCKET_ENTRIES), int(spark.conf.get("spark.sql.shuffle.partitions"))) | 1
    counted = ngrams(held, buckets).groupBy("bucket").applyInArrow(joined_counts, "block long, bucket int, totals binary")

    def score(table: pa.Table) -> pa.Table:
        """One block: its own row, and the totals of its n-grams from every bucket."""
        table = table.sort_by("bucket")  # the block's own row has none and comes last
        row = next(_rows(table.slice(table.num_rows - 1)))
        totals = np.concatenate([np.empty(0, np.int64), *(unpack(x).view(np.int64) for x in table.column("totals").to_pylist()[:-1])])
        return pa.table({"id": row["ids"], "n_words": pa.array(row["lengths"], pa.int64()), "log_score": pa.array(_block(row).scores(totals, total), pa.float64())})

    own = held.withColumns({"bucket": F.lit(None).cast("int"), "totals": F.lit(None).cast("binary")})
    both = own.unionByName(counted, allowMissingColumns=True)
    partial = both.groupBy("block").applyInArrow(score, "id long, n_words long, log_score double")
    scores = partial.groupBy("id").agg(F.sum("n_words").alias("n_words"), F.sum("log_score").alias("log_score"))
    return scores.select(F.col("id").cast(id_type).alias(id_column), "n_words", "log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")).alias("mean_log"))
