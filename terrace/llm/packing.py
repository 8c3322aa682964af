"""Best-fit packing with Martello-Toth dominance reduction.

A packing depends on lengths alone, so the instance is the count of pieces per length: at most `capacity` rows, whatever the size
of the corpus. On these counts the reduction first fixes sets that provably dominate every alternative: a piece that nothing fits
beside, a piece with a single other that fills the rest exactly, and a piece with the largest fitting one where no more than one
more piece fits, or no pair of them is larger. What is left goes best-fit, longest first. Equal sequences are one pattern with a
multiplicity, so this work does not grow with the corpus either.

Pieces then find their places by rank: the n-th piece of a length takes the n-th place that the patterns hold for that length.
Ranks are counted in hash buckets of pieces and added up over the buckets; no length, however common, meets in one task.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.byte_bpe import byte_characters
from terrace.llm.common import SAFE_PIECE, byte_slices, staged

SLICE_BYTES = 1 << 20
REMEMBERED_PIECES = 1 << 19
LONGEST_REMEMBERED = 40
#: Beyond this code point the two libraries may follow different Unicode versions; such pieces go to the file's own library.
SETTLED = 0x24F
Pattern = tuple[int, tuple[tuple[int, int], ...]]  # how many sequences, and of which (length, number of pieces) each


class PieceIds:
    """Ids of texts under a byte-level BPE file of the `tokenizers` library, as little-endian 32-bit integers.

    Where the file's merges are in the order of their ids, the rank-based encoder gives the same ids several times faster and is
    used for plain pieces; special strings and characters outside settled ranges go through the file's own library.
    """

    def __init__(self, path: str, pattern: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        vocabulary = held["model"]["vocab"]
        merged = [vocabulary["".join(m) if isinstance(m, list) else m.replace(" ", "", 1)] for m in held["model"]["merges"]]
        self.special = [t["content"] for t in held.get("added_tokens", [])]
        self.odd = re.compile("|".join([f"[^\0-{chr(SETTLED)}]", *map(re.escape, self.special)]))
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in vocabulary.items() if token not in self.special}
        self.by_rank = None
        if merged == sorted(merged):
            self.by_rank = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}

    def encode_new(self, pieces: set[str]) -> None:
        other = set(filter(self.odd.search, pieces)) if self.by_rank else pieces
        for piece in pieces - other:  # one by one: lists of ids that are kept wake the garbage collector
            ids = self.by_rank.encode_ordinary(piece)
            self.known[piece] = struct.pack(f"<{len(ids)}I", *ids)
        if other:
            order = [*other]
            found = self.tokenizer.encode_batch_fast(order, add_special_tokens=False)
            self.known.update((piece, np.array(e.ids, "<u4").tobytes()) for piece, e in zip(order, found, strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [SAFE_PIECE.findall(text) for text in texts]
        new = set().union(*cut).difference(self.known)
        if len(self.known) + len(new) > REMEMBERED_PIECES:
            self.known.clear()
            new = set().union(*cut)
        self.encode_new(new)
        out = [b"".join(map(self.known.__getitem__, pieces)) for pieces in cut]
        for piece in new:
            if len(piece) > LONGEST_REMEMBERED:
                del self.known[piece]
        return out


_IDS: dict[tuple[str, str], PieceIds] = {}


def ids_of(path: str, pattern: str) -> PieceIds:
    """One per worker process, file and pattern."""
    if (path, pattern) not in _IDS:
        _IDS[path, pattern] = PieceIds(path, pattern)
    return _IDS[path, pattern]


def document_pieces(docs: DataFrame, tokenizer: str, pattern: str, capacity: int = 2048, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Return id, piece, start, length and ids_crc32 for every piece of every document's ids with `end_id` behind them.

    A document of more than `capacity` ids is cut into pieces of that length, the first of which may be shorter; any other is one
    piece. A null text counts as empty: one piece with only `end_id`. Repeated rows give repeated pieces; an empty table gives an
    empty one; other columns are ignored.
    """
    id_type = docs.schema[id_column].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ids_of(tokenizer, pattern)
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                row, piece, start, length, crc = [], [], [], [], []
                for i, ids in enumerate(encoder.encode([text or "" for text in part.column("text").to_pylist()])):
                    ids += end
                    total = len(ids) // 4
                    cuts = [0, *range(total % capacity or capacity, total, capacity), total]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        row.append(i)
                        piece.append(k)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(ids[4 * a:4 * b]))
                yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                                                  *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                                                 names=["id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(run, f"id {id_type}, piece int, start long, length long, ids_crc32 long").withColumnRenamed("id", id_column)


def reduce_instance(counts: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """Sequences fixed by dominance, and the counts that are left."""
    left = {size: n for size, n in counts.items() if n > 0}
    order = sorted(left)  # lengths that are left, ascending
    fixed: list[Pattern] = []

    def take(size: int, n: int) -> None:
        left[size] -= n
        if not left[size]:
            del left[size]
            order.pop(bisect_left(order, size))

    def smallest(three: int, without: int) -> list[int]:
        found: list[int] = []
        for size in order:
            found += [size] * min(three, left[size] - (size == without))
            if len(found) >= three:
                break
        return found[:three]

    def largest_pair(most: int, without: int) -> int:
        """The largest sum, up to `most`, of two of the other pieces; 0 if there is none."""
        free = {size: left[size] - (size == without) for size in order if size < most}
        usable = [size for size, n in free.items() if n]
        best, low, high = 0, 0, len(usable) - 1
        while low <= high:
            total = usable[low] + usable[high]
            if total > most:
                high -= 1
                continue
            if low < high or free[usable[low]] > 1:
                best = max(best, total)
            low += 1
        return best

    for size in sorted(left, reverse=True):
        rest = capacity - size
        while left.get(size):
            others = smallest(3, size)
            if not others or others[0] > rest:
                fixed.append((left[size], ((size, 1),)))
                take(size, left[size])
                continue
            at = bisect_left(order, rest + 1) - 1
            if order[at] == size and left[size] == 1:
                at -= 1
            partner = order[at]
            if not (partner == rest or sum(others[:2]) > rest or len(others) == 1
                    or ((len(others) == 2 or sum(others) > rest) and largest_pair(rest, size) <= partner)):
                break
            if partner == size:
                n = left[size] // 2
                fixed.append((n, ((size, 2),)))
                take(size, 2 * n)
            else:
                n = min(left[size], left[partner])
                fixed.append((n, ((size, 1), (partner, 1))))
                take(size, n)
                take(partner, n)
    return fixed, left


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit, longest first. A sequence that is open and fits best goes on fitting best until it is too full for that length."""
    room: dict[int, list[Pattern]] = {}  # open sequences by what is free in them
    frees: list[int] = []

    def put(free: int, entry: Pattern) -> None:
        if free not in room:
            room[free] = []
            insort(frees, free)
        room[free].append(entry)

    for size in sorted(counts, reverse=True):
        n = counts[size]
        while n:
            at = bisect_left(frees, size)
            if at < len(frees):
                free = frees[at]
                many, held = room[free].pop()
                if not room[free]:
                    del room[free]
                    frees.pop(at)
            else:
                free, many, held = capacity, n, ()
            each = free // size
            full = min(many, n // each)
            if full:
                put(free - each * size, (full, (*held, (size, each))))
                n -= full * each
            if full < many and n:  # too few are left to fill one more
                put(free - n * size, (1, (*held, (size, n))))
                full, n = full + 1, 0
            if full < many and held:
                put(free, (many - full, held))
    return [entry for entries in room.values() for entry in entries]


def pack_counts(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns that hold every piece; each piece is at least 1 and at most `capacity` long."""
    fixed, left = reduce_instance(counts, capacity)
    return fixed + best_fit(left, capacity)


def places(patterns: list[Pattern]) -> np.ndarray:
    """Runs of places, ordered by length and rank: length, first rank, pieces of that length per sequence, first sequence, offset."""
    runs, ranks, sequence = [], {}, 0
    for many, held in patterns:
        offset = 0
        for size, n in held:
            runs.append((size, ranks.get(size, 0), n, sequence, offset))
            ranks[size] = ranks.get(size, 0) + many * n
            offset += size * n
        sequence += many
    return np.array(sorted(runs), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """Add sequence_id and offset to rows with a `length` from 1 to `capacity`.

    Rows of any other length, or of none, are an error: they fit into no sequence. Equal rows are packed one by one; which of
    several rows of one length takes which place is settled by a hash of the row. An empty table gives an empty one. Columns of
    these names in the input are replaced.
    """
    spark = pieces.sparkSession
    pieces = pieces.drop("sequence_id", "offset")
    names = pieces.columns
    length = F.col("length").cast("long")
    fits = F.when(length.between(1, capacity), length).otherwise(F.raise_error(F.lit("a piece fits into no sequence")).cast("long"))
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = pieces.select(F.struct(*names).alias("row"), fits.alias("size"), F.xxhash64(*names).alias("mix"))
    rows = rows.withColumn("bucket", F.pmod("mix", F.lit(buckets)).cast("int"))
    groups = staged(rows.groupBy("bucket", "size").agg(F.count("*").alias("n")), "lengths")
    counts = {r["size"]: r["n"] for r in groups.groupBy("size").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    runs = places(pack_counts(counts, capacity))
    keys = runs[:, 0] << 44 | runs[:, 1]  # ranks stay below 2 ** 44

    before = Window.partitionBy("size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = groups.select("bucket", "size", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    local = F.row_number().over(Window.partitionBy("bucket", "size").orderBy("mix")) - 1
    ranked = rows.withColumn("local", local).join(firsts, ["bucket", "size"]).select("row", "size", (F.col("first") + F.col("local")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("size", "rank"))
            run = runs[np.searchsorted(keys, size << 44 | rank, side="right") - 1]
            within = rank - run[:, 1]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(run[:, 3] + within // run[:, 2]), pa.array(run[:, 4] + within % run[:, 2] * size)],
                                             names=["row", "sequence_id", "offset"])

    row_type = ranked.schema["row"].dataType.simpleString()
    return ranked.mapInArrow(place, f"row {row_type}, sequence_id long, offset long").select("row.*", "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer: str, pattern: str, capacity: int = 2048, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Pieces of all documents (see `document_pieces`) with their places (see `pack`)."""
    pieces = document_pieces(docs, tokenizer, pattern, capacity, end_id, id_column, text_column)
    return pack(staged(pieces, "pieces"), capacity)
