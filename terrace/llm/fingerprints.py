"""Document fingerprints of closed syncmers.

A text is a sequence of words. A run of K words is an anchor if the smallest hash among its inner runs of S words is that of its
first or last one. Whether a run is chosen depends on nothing outside it, so equal passages give equal anchors wherever they stand,
and any K - S + 1 successive runs hold an anchor. In front of a text stand K - 1 empty words, so that short texts have anchors
too. The anchors with their places, in order, are the fingerprint. For the likeness of two texts their anchors are matched, each with the next
equal one of the other text, and the matches that agree in how far the places are apart are counted (as a share of all anchors, Dice):
passages in another order, or the same passage again and again, do not add up. All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import once

K, S = 7, 2
#: Matches agree if they fall in two neighbouring bands of offsets; a band is an eighth of the longer text, and this many words at least.
BAND_PARTS, LEAST_BAND = 8, 16
GAPS = r"[\x20\x09-\x0D]+"


def _padded(text: Column) -> Column:
    return F.concat(F.array_repeat(F.lit(""), K - 1), F.array_remove(F.split(text, GAPS), ""))


def _inner(words: Column) -> Column:
    """Hashes of all runs of S words."""
    return F.transform(F.sequence(F.lit(0), F.size(words) - S), lambda i: F.xxhash64(*(F.get(words, i + j) for j in range(S))))


def _chosen(inner: Column) -> Column:
    """Starts of the runs of K words that are anchors."""
    width = K - S
    last = F.size(inner) - 1 - width
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    at = lambda i: F.get(inner, i)
    return F.filter(starts, lambda i: (at(i) <= F.least(*(at(i + j) for j in range(1, width + 1)))) | (at(i + width) <= F.least(*(at(i + j) for j in range(width)))))


def with_anchors(rows: DataFrame, text_column: str, name: str) -> DataFrame:
    """Add the anchors of a text that isn't null as an array of numbers, in order: a 32-bit hash and, in the lower half, the place of the first word.

    Steps are columns of their own, so that each is computed once. A text without words has no anchors.
    """
    names = rows.columns
    words = rows.select(*names, _padded(F.col(text_column)).alias("_words"))
    inner = words.select(*names, _inner(F.col("_words")).alias("_inner"))
    chosen = inner.select(*names, "_inner", _chosen(F.col("_inner")).alias("_chosen"))
    parts = [*range(0, K - S, S), K - S]  # inner runs that cover the K words
    anchor = lambda i: F.hash(*(F.get(F.col("_inner"), i + j) for j in parts))
    return chosen.select(*names, F.transform("_chosen", lambda i: F.shiftleft(anchor(i).cast("long"), 32) + i).alias(name))


def _place(number: Column) -> Column:
    return number.bitwiseAND(F.lit((1 << 32) - 1))


def _offsets(a: Column, b: Column) -> Column:
    """How far matching anchors are apart. An anchor, its place and its text are one number, so that sorting them is cheap."""
    def numbers(anchors: Column, side: int) -> Column:
        return F.transform(anchors, lambda x: x + _place(x) + side)  # twice the place, and which text

    def pairs(both: Column) -> Column:
        def offset(x: Column, i: Column) -> Column:
            following, side, place = F.get(both, i + 1), lambda n: n.bitwiseAND(F.lit(1)), lambda n: F.shiftright(_place(n), 1)
            matches = (F.shiftright(x, 32) == F.shiftright(following, 32)) & (side(x) != side(following))
            return F.when(matches, (place(following) - place(x)) * (1 - 2 * side(x)))
        return F.filter(F.transform(both, offset), lambda d: d.isNotNull())
    return once(F.sort_array(F.concat(numbers(a, 0), numbers(b, 1))), pairs)


def _most_in_two_bands(bands: Column) -> Column:
    """The most numbers that are equal to, or one above, some number. Offsets are no larger than the longer text, so there are few bands."""
    edge = BAND_PARTS + 1

    def most(held: Column) -> Column:
        counts = [F.size(held) - F.size(F.array_remove(held, F.lit(k).cast("long"))) for k in range(-edge, edge)]
        return F.greatest(*(x + y for x, y in zip(counts, counts[1:])))
    return once(bands, most)


def likeness(a: Column, b: Column) -> Column:
    """Twice the anchors that match at places equally far apart over all anchors; 1 for two texts without any."""
    total = F.size(a) + F.size(b)
    last = lambda x: F.coalesce(_place(F.get(x, F.size(x) - 1)), F.lit(0))
    band = F.greatest(F.lit(LEAST_BAND), F.floor(F.greatest(last(a), last(b)) / BAND_PARTS))
    most = once(band, lambda w: _most_in_two_bands(F.transform(_offsets(a, b), lambda d: F.floor(d / w))))
    return F.when(total == 0, 1.0).otherwise(2.0 * F.least(most, F.size(a), F.size(b)) / total)


def as_text(anchors: Column) -> Column:
    return F.array_join(F.transform(anchors, lambda x: F.concat_ws(":", _place(x), F.shiftright(x, 32))), " ")


def _bounds(rows: DataFrame, key: str, buckets: int) -> tuple[list[int], int | None]:
    """Keys that cut the rows into about equal ranges, none of them the smallest key; and the smallest key."""
    shares = [i / buckets for i in range(1, buckets)]
    found = rows.agg(F.min(key).alias("low"), F.percentile_approx(key, F.lit(shares), 10_000).alias("cuts")).head()
    return sorted({cut for cut in found["cuts"] or [] if cut > found["low"]}), found["low"]


def _bucket(key: Column, bounds: list[int]) -> Column:
    """How many of the bounds are not above the key, by halving."""
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    if not steps:
        return F.lit(0)
    table = F.lit(bounds)
    return F.aggregate(F.lit(steps), F.lit(0), lambda at, step: F.when((at + step <= len(bounds)) & (F.get(table, at + step - 1) <= key), at + step).otherwise(at))


def with_next(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Add next_<column> from the row of the next key; the last row's next is the first row. Equal keys follow a hash of the row.

    Rows are dealt into ranges of keys. A range also gets a copy of the first row behind it, known from its key, so no second pass
    and no window over all rows is needed.
    """
    spark = rows.sparkSession
    bounds, low = _bounds(rows, key, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    bucket = _bucket(F.col(key), bounds)
    own = rows.select("*", bucket.alias("_bucket"), F.xxhash64(*columns).alias("_mix"))
    starts = (F.col("_bucket") > 0) & (F.get(F.lit(bounds or [0]).cast("array<bigint>"), F.col("_bucket") - 1) == F.col(key))
    places = F.array(
        F.struct(F.col("_bucket").alias("bucket"), F.lit(0).alias("after")),
        F.when(starts, F.struct((F.col("_bucket") - 1).alias("bucket"), F.lit(1).alias("after"))),
        F.when(F.col(key) == F.lit(low), F.struct(F.lit(len(bounds)).alias("bucket"), F.lit(2).alias("after"))))
    dealt = own.select("*", F.explode(F.filter(places, lambda p: p.isNotNull())).alias("_place")).withColumn("_to", F.col("_place.bucket"))
    order = Window.partitionBy("_to").orderBy("_place.after", key, "_mix")
    following = dealt.select("*", *(F.lead(c).over(order).alias(f"next_{c}") for c in columns))
    return following.filter(F.col("_place.after") == 0).drop("_bucket", "_mix", "_place", "_to")


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Return id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next for every row.

    The edited text has its last quarter of code points replaced by as many of the next document's first ones, or all it has. The
    next document is that of the next id (a null id comes first); the last one's next is the first, and a lone document's next is
    itself. A null text counts as empty. Between rows of one id a hash of the text decides; repeated rows each get a result. An
    empty table gives an empty one; other columns are ignored.
    """
    id_type = docs.schema[id_column].dataType
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(id_column).cast("long"), F.lit(-(1 << 63))).alias("key"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    near = with_next(with_anchors(rows, "text", "anchors"), "key", ["text", "anchors"])
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - quarter), F.substring(F.col("next_text"), F.lit(1), quarter))
    near = near.select("id", n.cast("long").alias("n_chars"), edited.alias("edited"), "anchors", "next_anchors")
    near = with_anchors(near, "edited", "edited_anchors")
    return near.select(
        F.col("id").cast(id_type).alias(id_column), "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("anchors")).alias("fingerprint"), as_text(F.col("edited_anchors")).alias("edited_fingerprint"),
        likeness(F.col("anchors"), F.col("edited_anchors")).alias("near_edited"), likeness(F.col("anchors"), F.col("next_anchors")).alias("near_next"))
