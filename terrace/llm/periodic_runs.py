"""Periodic runs of words, found on a grammar of the texts.

A run is a stretch of words with smallest period q, at least MIN_POWER * q and MIN_LENGTH words long, that no neighbouring word extends
with that period. Documents are independent, so they stay where they are read: a slice of about SLICE_BYTES of them is one sequence
of word ids, with an id of its own behind each document, so that nothing reaches across. On that sequence

* Re-Pair replaces pairs that occur twice or more by nonterminals, until none does. A round takes every pair wherever it is more
  frequent than the pairs it overlaps, so a round is a few array operations and the rounds are few;
* each nonterminal, and each inner node of a balanced tree over what is left of a document, has one boundary between its halves. Runs
  that cross it are computed once, inside the node's first occurrence. A run of period q that crosses a boundary holds, at one of
  a few places before it, a gram of 2^k words (q <= 2^k < 2q) whose next occurrence is q words on, and by periodicity that
  distance is the smallest period; how far the period reaches follows from the ids of grams of 2^k words by doubling;
* runs of nonterminals are translated to all their places in the derivation, and stretches inside others of the same period go. Every
  run lies whole in the lowest node that holds it, where it crosses the boundary, so what is left are the maximal runs.

Memory and time follow the slice, or a single text that is longer.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import byte_slices

SLICE_BYTES = 1 << 20
MIN_LENGTH, MIN_POWER = 6, 4
Edit = Callable[[int, list[bytes]], list[bytes]]


def _group(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order that brings equal codes together, the number of each place's group in that order, and the groups' sizes."""
    order = np.argsort(codes, kind="stable")
    held = codes[order]
    new = np.ones(len(held), bool)
    new[1:] = held[1:] != held[:-1]
    return order, np.cumsum(new) - 1, np.diff(np.append(np.flatnonzero(new), len(held)))


class Grammar:
    """Re-Pair over a sequence of ids below `terminals`.

    Nonterminal terminals + i has halves left[i] and right[i] and spans size[i] ids; its first occurrence starts at first[i]. `rounds`
    are the edges of the rounds, in which no nonterminal refers to another. `sequence` is what is left, and `place` where each of its
    symbols starts.
    """

    def __init__(self, ids: np.ndarray, terminals: int):
        self.terminals, self.rounds = terminals, [0]
        left, right, first, middle, end = ([np.empty(0, np.int64)] for _ in range(5))
        seq, place = ids.astype(np.int64), np.arange(len(ids) + 1, dtype=np.int64)
        active = np.ones(len(seq), bool)  # whether the pair that starts here may occur again; others never will
        active[-1:] = False
        symbols = terminals
        while len(at := np.flatnonzero(active)):
            a, b = seq[at], seq[at + 1]
            if (a == b).any():  # of overlapping pairs of one symbol every second counts
                same = np.append(seq[:-1] == seq[1:], False)
                begins = np.maximum.accumulate(np.where(same & ~np.append(False, same[:-1]), np.arange(len(seq)), 0))
                apart = (a != b) | ((at - begins[at]) % 2 == 0)
            else:
                apart = np.ones(len(at), bool)
            order, group, _ = _group(a * symbols + b)
            counts = np.bincount(group, apart[order])
            rank = np.empty(len(counts), np.int32)
            rank[np.argsort(-counts, kind="stable")] = np.arange(len(counts))
            again = counts[group] > 1
            place_of, group = order[again], group[again]
            active = np.zeros(len(seq), bool)
            active[at[place_of]] = True
            usable = apart[place_of]
            where, group = at[place_of[usable]], group[usable]
            if not len(where):
                break
            priority = np.full(len(seq) + 2, np.iinfo(np.int32).max, np.int32)
            priority[where + 1] = rank[group]
            best = (priority[where + 1] < priority[where]) & (priority[where + 1] < priority[where + 2])
            where, group = where[best], group[best]
            enough = np.bincount(group, minlength=len(counts))[group] > 1
            where, group = where[enough], group[enough]
            if len(where):
                kinds, firsts, which = np.unique(group, return_index=True, return_inverse=True)
                start = where[firsts]
                left.append(seq[start])
                right.append(seq[start + 1])
                first.append(place[start])
                middle.append(place[start + 1])
                end.append(place[start + 2])
                seq[where] = symbols + which
                symbols += len(kinds)
                self.rounds.append(symbols - terminals)
                active[where] = True
                active[where[where > 0] - 1] = True
                keep = np.ones(len(seq) + 1, bool)
                keep[where + 1] = False
                seq, active, place = seq[keep[:-1]], active[keep[:-1]], place[keep]
            active[-1:] = False
        self.left, self.right, self.first, self.middle, self.end = (np.concatenate(x) for x in (left, right, first, middle, end))
        self.sequence, self.place = seq, place

    def nodes(self, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, boundary and end of each nonterminal's first occurrence, then those of the inner nodes of the balanced trees
        over what is left of each document. A document's symbols end with an id that `separators` marks."""
        n = len(self.sequence)
        at = np.arange(1, n)
        closes = np.flatnonzero((self.sequence < self.terminals) & separators[np.minimum(self.sequence, self.terminals - 1)])
        doc = np.searchsorted(closes, at)
        low, high = np.append(0, closes + 1)[doc], closes[np.minimum(doc, len(closes) - 1)] if len(closes) else at
        inside = (at > low) & (at < high)
        at, low, high = at[inside], low[inside], high[inside]
        reach = at & -at  # any stretch of symbols has one boundary of largest reach, and lies within its reach
        starts, ends = np.maximum(at - reach, low), np.minimum(at + reach, high)
        return (np.concatenate([self.first, self.place[starts]]), np.concatenate([self.middle, self.place[at]]), np.concatenate([self.end, self.place[ends]]))

    def translate(self, symbol: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Stretches inside nonterminals, by offsets, at all places of the derivation."""
        order = np.argsort(symbol, kind="stable")
        symbol, start, end, period = symbol[order], start[order], end[order], period[order]
        own = np.zeros(len(self.left), bool)
        own[symbol] = True
        holds = np.append(own, False)  # the last place stands for terminals
        number = lambda x: np.where(x >= self.terminals, x - self.terminals, len(own))
        left, right, size = number(self.left), number(self.right), self.middle - self.first
        for a, b in zip(self.rounds, self.rounds[1:], strict=False):
            holds[a:b] |= holds[left[a:b]] | holds[right[a:b]]
        nodes, places, out = number(self.sequence), self.place[:-1], []
        while True:
            some = holds[nodes]
            nodes, places = nodes[some], places[some]
            if not len(nodes):
                break
            mine = own[nodes]
            low, high = np.searchsorted(symbol, nodes[mine]), np.searchsorted(symbol, nodes[mine], "right")
            n = high - low
            row = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
            shift = np.repeat(places[mine], n)
            out.append((start[row] + shift, end[row] + shift, period[row]))
            nodes, places = np.concatenate([left[nodes], right[nodes]]), np.concatenate([places, places + size[nodes]])
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (start[:0],) * 3


class Grams:
    """For each k the ids of the grams of 2^k words that occur again (others have a negative number of their own), and `near`: how far
    on a gram's next occurrence is, if that is more than 2^(k-1) and at most 2^k, else 0."""

    def __init__(self, ids: np.ndarray):
        self.length, self.ids, self.near = len(ids), [], []
        at, code, k = np.arange(len(ids)), ids.astype(np.int64), 0
        while len(at):
            order, group, sizes = _group(code)
            again = sizes[group] > 1
            where, group = at[order[again]], group[again]
            if not len(where):
                break
            held, near = -1 - np.arange(self.length, dtype=np.int32), np.zeros(self.length, np.int32)
            held[where] = group
            ahead = np.append(np.where(group[1:] == group[:-1], np.diff(where), 0), 0)
            near[where] = np.where((2 * ahead > 1 << k) & (ahead <= 1 << k), ahead, 0)
            self.ids.append(held)
            self.near.append(near)
            at = np.sort(where)
            at = at[at + (1 << k) < self.length]
            at = at[held[at + (1 << k)] >= 0]
            code = held[at].astype(np.int64) * (len(sizes) + 1) + held[at + (1 << k)]
            k += 1

    def agree(self, a: np.ndarray, b: np.ndarray, back: bool) -> np.ndarray:
        """How many words from a < b on, or before them if `back`, are the same."""
        total = np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.ids))):
            step = 1 << k
            x, y = (a - total - step, b - total - step) if back else (a + total, b + total)
            fits = x >= 0 if back else y + step <= self.length
            x, y = np.where(fits, x, 0), np.where(fits, y, 0)
            total += np.where(fits & (self.ids[k][x] == self.ids[k][y]), step, 0)
        return total


def crossing_runs(grams: Grams, start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """The runs inside each node that cross its boundary: node, start, end, period."""
    width, found = end - start, []
    for k, near in enumerate(grams.near):
        if not near.any():
            continue
        node = np.flatnonzero((width >= MIN_LENGTH) & (width > 2 << k))
        step, probes = max(1 << k >> 1, 1), 4 if k == 0 else 8  # a run holds its gram's place within MIN_POWER - 1 periods before the boundary
        for c in range(probes):
            at = middle[node] - c * step
            inside = at >= start[node]
            at, some = at[inside], node[inside]
            period = near[at]
            hit = period > 0
            found.append((some[hit], at[hit], period[hit].astype(np.int64)))
    if not found:
        return (np.empty(0, np.int64),) * 4
    node, at, period = (np.concatenate(x) for x in zip(*found, strict=True))
    _, one, which = np.unique(at * (grams.length + 1) + period, return_index=True, return_inverse=True)
    a, q = at[one], period[one]
    low, high = a - grams.agree(a, a + q, True), a + q + grams.agree(a, a + q, False)
    low, high = np.maximum(low[which], start[node]), np.minimum(high[which], end[node])
    whole = (high - low >= np.maximum(MIN_LENGTH, MIN_POWER * period)) & (low < middle[node]) & (high > middle[node])
    return tuple(np.unique(np.stack([node[whole], low[whole], high[whole], period[whole]]), axis=1))


def maximal(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches that lie in no other of their period, each once, by start and period."""
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    group = np.cumsum(np.append(True, period[1:] != period[:-1])) if len(period) else period
    reach = end + group * (end.max(initial=0) + 1)
    keep = np.ones(len(reach), bool)
    keep[1:] = reach[1:] > np.maximum.accumulate(reach)[:-1]
    start, end, period = start[keep], end[keep], period[keep]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def runs_of(documents: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words: (start, length, period) by start and period."""
    words = [w for document in documents for w in document]
    known = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
    lengths = np.array([len(document) for document in documents], np.int64)
    ends = np.cumsum(lengths)
    ids = np.insert(ids, ends, len(known) + np.arange(len(documents)))  # a separator behind each document
    terminals = len(known) + len(documents)
    grammar = Grammar(ids, terminals)
    start, middle, end = grammar.nodes(np.arange(terminals) >= len(known))
    node, low, high, period = crossing_runs(Grams(ids), start, middle, end)
    inner = node < len(grammar.left)
    offset = start[node[inner]]
    moved = grammar.translate(node[inner], low[inner] - offset, high[inner] - offset, period[inner])
    rest = low[~inner], high[~inner], period[~inner]
    low, high, period = maximal(*(np.concatenate(x) for x in zip(moved, rest, strict=True)))
    begins = np.append(0, ends[:-1] + np.arange(1, len(documents)))
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    doc = np.searchsorted(begins, low, "right") - 1
    for d, s, f, q in zip(doc.tolist(), (low - begins[doc]).tolist(), (high - begins[doc]).tolist(), period.tolist(), strict=True):
        out[d].append((s, f - s, q))
    return out


def without_repeats(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


def periodic_runs(docs: DataFrame, edit: Edit | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Return id, n_words, runs (array of start, length, period, by start and period) and collapsed for every row.

    Words are separated by space and \\t to \\r; collapsed is the words that no run contains after its first period, joined by one space.
    `edit` changes a document's words first, given its id. A null or blank text has no words, no runs and an empty collapsed text.
    Repeated rows each get a result; an empty table gives an empty one; other columns are ignored.
    """
    id_type = docs.schema[id_column].dataType.simpleString()
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                cut = [(text or "").encode("utf-8", "surrogatepass").split() for text in part.column("text").to_pylist()]  # of bytes: ASCII white space only
                if edit:
                    cut = [edit(i, words) for i, words in zip(part.column("id").to_pylist(), cut, strict=True)]
                found = runs_of(cut)
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), pa.array([len(words) for words in cut], pa.int64()),
                    pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for runs in found], kind),
                    pa.array([b" ".join(without_repeats(words, runs)).decode("utf-8", "surrogatepass") for words, runs in zip(cut, found, strict=True)], pa.string()),
                ], names=["id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(run, f"id {id_type}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string").withColumnRenamed("id", id_column)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a tenth of the documents, chosen by a hash of the id, repeat with some period from some word on. Without an id nothing changes."""
    if doc_id is None or not words:
        return words
    g, chosen = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if chosen:
        return words
    n = len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def strongest(runs: Column) -> Column:
    """The run of greatest length / period, compared exactly; of equal ones the first by start and period. Null without runs."""
    better = lambda a, b: b["length"] * a["period"] > a["length"] * b["period"]
    return F.aggregate(F.slice(runs, F.lit(2), F.greatest(F.size(runs) - 1, F.lit(0))), F.get(runs, 0), lambda best, r: F.when(better(best, r), r).otherwise(best))


def run_digests(docs: DataFrame, edit: Edit | None = planted, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Return id, n_runs, start, length, period and exponent_milli of the strongest run (nulls without runs), runs_sha256 and
    collapsed_sha256 for every row; see `periodic_runs`."""
    rows = periodic_runs(docs, edit, id_column, text_column).withColumn("best", strongest(F.col("runs")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return rows.select(
        id_column, F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"), F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
