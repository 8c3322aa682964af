"""Spelling variants: words one edit apart, each led to its most frequent neighbour.

Counts come first: words are counted per document and task before they are shuffled. The vocabulary is then sorted, and neighbours are found
by dynamic programming along the sorted list: the rows of the edit matrix (banded to the three cells that one edit can reach) are kept
as far as a word shares its prefix with the word before it, and as soon as a row exceeds one edit, all words with that prefix are
skipped.

So that no task scans the whole vocabulary, words meet in lists of those that agree where the edit is not. Of two words one edit
apart, the shorter one m code points long, either the first m / 2 code points agree or the last m - m / 2. The words of a list agree
in their first `head` and last `tail` code points; a list with more than MOST_IN_A_LIST words is dealt again by halving what lies between, until it is short
or only one code point lies between, where a list has no more words than the alphabet has letters. Each pair belongs to one list: the one
of the head if the heads agree, else that of the tail. Lists arrive sorted by Spark, many in a task, and one at a time is held.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import byte_slices, staged

SLICE_BYTES = 1 << 20
REMEMBERED_WORDS = 1 << 18
MOST_IN_A_LIST = 2_000
PAIRS_IN_A_BATCH = 1 << 16
#: Letters as UTF-8: a to z and U+00C0 to U+00FF.
LETTER = rb"(?:[a-z]|\xc3[\x80-\xbf])"
Edit = Callable[[int, bytes], bytes]


def code_points(word: bytes) -> int:
    return len(word) - word.count(b"\xc3")


def word_counts(docs: DataFrame, least_length: int, edit: Edit | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Return word and n for the runs of letters of all texts with `least_length` code points or more, A-Z lower-cased.

    `edit` changes a document's runs first, given its id; it may shorten them.
    """
    letters = re.compile(LETTER + b"{%d,}" % least_length)  # shorter runs never match, not even in part

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()).cast(pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                for doc_id, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    found = Counter(letters.findall((text or "").encode("utf-8", "surrogatepass").lower()))  # of bytes: A-Z only
                    if edit:
                        for word, n in found.items():
                            word = edit(doc_id, word)
                            if code_points(word) >= least_length:
                                counts[word] += n
                    else:
                        counts.update(found)
                    if len(counts) > REMEMBERED_WORDS:
                        yield flush()
        yield flush()

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def one_left_out(doc_id: int | None, word: bytes) -> bytes:
    """One code point of some of a document's words is left out, chosen by a hash of id and word. Without an id nothing changes."""
    if doc_id is None:
        return word
    h = zlib.crc32(b"%d:%s" % (doc_id, word))
    if h % 199:
        return word
    letters = word.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1:]).encode()


def near_in_order(words: list[str]) -> Iterator[tuple[int, int]]:
    """Pairs i < j of a sorted list of distinct words that are one edit apart.

    A row after d code points of a word holds the edits to the query's prefixes of d - 1, d and d + 1 code points; 2 stands for more
    than one. The query's own rows are (1, 0, 1), so a word that follows it starts where it leaves the query's prefix.
    """
    n = len(words)
    shared = [0] * (n + 1)  # code points in common with the word before
    for i in range(1, n):
        a, b = words[i - 1], words[i]
        most = min(len(a), len(b))
        d = 0
        while d < most and a[d] == b[d]:
            d += 1
        shared[i] = d
    shared[n] = -1
    less = [n] * (n + 1)  # the next place that shares less
    stack: list[int] = []
    for i in range(n + 1):
        while stack and shared[stack[-1]] > shared[i]:
            less[stack.pop()] = i
        stack.append(i)
    for i, query in enumerate(words):
        size = len(query)
        rows = [(1, 0, 1)] * (size + 2)
        held, j = size, i + 1  # rows 0..held are those of the word before j
        while j < n:
            word = words[j]
            d = min(shared[j], held)
            row, length = rows[d], len(word)
            while d < length:
                a, b, c = row
                letter = word[d]
                # cells d, d + 1 and d + 2 of the query after one more code point
                x = a if d > 0 and d - 1 < size and query[d - 1] == letter else 1 + (a if a < b else b)
                if d == 0:
                    x = 1
                y = b if d < size and query[d] == letter else 1 + min(x, b, c)
                z = c if d + 1 < size and query[d + 1] == letter else 1 + min(y, c)
                row = (x if x < 2 else 2, y if d + 1 <= size and y < 2 else 2, z if d + 2 <= size and z < 2 else 2)
                d += 1
                if d < len(rows):
                    rows[d] = row
                else:
                    rows.append(row)
                if min(row) > 1:
                    break
            else:
                gap = size - length
                if -1 <= gap <= 1 and row[gap + 1] == 1:
                    yield i, j
                held = d
                j += 1
                continue
            held = d
            j += 1
            while shared[j] >= d:  # the prefix of d code points is beyond one edit
                j = less[j]


def _halves(word: Column, length: Column, least_length: int) -> Column:
    """The lists a word is in first: for the lengths m of the shorter word that it can form a pair with, that of its head and that of its tail."""
    def places(m: Column) -> Column:
        half = F.floor(m / 2).cast("int")
        return F.array(F.struct(m.alias("m"), half.alias("head"), F.lit(0).alias("tail")), F.struct(m.alias("m"), F.lit(0).alias("head"), (m - half).alias("tail")))
    return F.concat(places(length), F.when(length > least_length, places(length - 1)).otherwise(F.array().cast("array<struct<m:int,head:int,tail:int>>")))


def _listed(rows: DataFrame) -> DataFrame:
    """Add the list of a word, a hash of what its words agree in, and what lies between."""
    head, tail, size = F.col("place.head"), F.col("place.tail"), F.char_length("word")
    start, end = F.substring(F.col("word"), F.lit(1), head), F.substring(F.col("word"), size - tail + 1, tail)
    return rows.withColumns({"list": F.xxhash64("place.m", head, tail, start, end), "between": F.substring(F.col("word"), head + 1, size - head - tail)})


def _halved(rows: DataFrame) -> DataFrame:
    """The lists again by half of what lies between."""
    m, head, tail = F.col("place.m"), F.col("place.head"), F.col("place.tail")
    middle = F.floor((head + m - tail) / 2).cast("int")
    parts = F.array(F.struct(m.alias("m"), middle.alias("head"), tail.alias("tail")), F.struct(m.alias("m"), head.alias("head"), (m - middle).alias("tail")))
    return _listed(rows.select("word", "n", F.explode(parts).alias("place")))


def word_lists(vocabulary: DataFrame, least_length: int, most: int = MOST_IN_A_LIST) -> DataFrame:
    """From word and n: word, n, place (m, head, tail), list and between, with no list longer than `most` that can be dealt again."""
    rows = vocabulary.select("word", "n", F.explode(_halves(F.col("word"), F.char_length("word"), least_length)).alias("place"))
    rows, done = _listed(rows), None
    while True:
        splits = F.col("place.m") - F.col("place.head") - F.col("place.tail") > 1
        long = staged(rows.filter(splits).groupBy("list").agg(F.count("*").alias("m")).filter(F.col("m") > most).select("list"), "long-lists")
        if long.isEmpty():
            return rows if done is None else done.unionByName(rows)
        short = rows.join(long, "list", "left_anti").select(*rows.columns)
        done = short if done is None else done.unionByName(short)
        rows = staged(_halved(rows.join(long, "list", "left_semi").select(*rows.columns)), "halved-lists")


def near_words(vocabulary: DataFrame, least_length: int, most: int = MOST_IN_A_LIST) -> DataFrame:
    """From word and n: word, n, near and near_n for all pairs of words one edit apart, in both orders.

    Words must be distinct and have `least_length` code points or more.
    """
    lists = word_lists(vocabulary, least_length, most)
    rows = lists.select("list", "place.*", "between", "word", "n").repartition("list").sortWithinPartitions("list", "m", "head", "tail", "between")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[str, str, int]] = []
        last: list[int] = []  # list, m, head and tail of what is held
        out: list[list] = [[], [], [], []]

        def scan() -> None:
            if len(held) < 2:
                return
            _, m, head, tail = last
            for i, j in near_in_order([between for between, *_ in held]):
                (_, a, a_n), (_, b, b_n) = held[i], held[j]
                if min(len(a), len(b)) != m or tail and a[:m - tail] == b[:m - tail]:
                    continue  # of another length, or of the list of their head
                if a[:head] != b[:head] or a[len(a) - tail:] != b[len(b) - tail:]:
                    continue  # lists whose hashes are equal
                for x, values in zip(out, ((a, b), (a_n, b_n), (b, a), (b_n, a_n)), strict=True):
                    x.extend(values)

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(out, (pa.string(), pa.int64()) * 2, strict=True)], names=["word", "n", "near", "near_n"])
            for x in out:
                x.clear()
            return batch

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("list", "m", "head", "tail", "between", "word", "n")]
            for *name, between, word, n in zip(*columns, strict=True):
                if name != last:
                    scan()
                    held.clear()
                    last[:] = name
                    if len(out[0]) > PAIRS_IN_A_BATCH:
                        yield flush()
                held.append((between, word, n))
        scan()
        yield flush()

    return rows.mapInArrow(run, "word string, n long, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """From word and form: word and root, by following forms to the last. Forms lead to ever more frequent words, so there is no circle."""
    reached = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        after = staged(reached.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        reached = after.select("word", "root")
        if after.filter("moved").isEmpty():
            return reached


def spelling_variants(docs: DataFrame, edit: Edit | None = None, least_length: int = 6, least_count: int = 5, factor: int = 5, most: int = MOST_IN_A_LIST,
                      id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Return word, form, root, n, n_near and form_n for every word of at least `least_length` code points and `least_count` occurrences.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF with A-Z lower-cased. form is the most frequent word one edit away (of
    equally frequent ones the first in code-point order) if it is at least `factor` times as frequent as the word, else null; root is
    reached by following forms; n_near is how many words are one edit away. `edit` changes a document's words before they are counted.
    Null texts have no words; repeated rows count again; an empty table, or one without such words, gives an empty one; other columns
    are ignored.
    """
    counted = word_counts(docs, least_length, edit, id_column, text_column)
    words = staged(counted.filter(F.col("n") >= least_count), "vocabulary")
    pairs = near_words(words, least_length, most)
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    known = staged(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.less") >= factor * F.col("n"), F.struct(F.col("best.near").alias("form"), (-F.col("best.less")).alias("form_n"))).alias("lead")), "near")
    known = known.select("word", F.col("lead.form").alias("form"), "n", "n_near", F.col("lead.form_n").alias("form_n"))
    ends = roots(known.filter("form IS NOT NULL"))
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
