"""MinHash near-dedup with bottom-k sketches from one hash function.

A document's set is its distinct word shingles, as 64-bit hashes. The K smallest are its sketch. Documents of equal sets are one
class from the start, so exact copies never meet in a list; classes are numbered, and a class is known by one text of it, which is found by two hashes. Candidates come from inverted lists of retained values:

* Two sets of similarity t share about t of their sketches; less than share_of(t) of it only with a probability under MISSED. Sketches
  that overlap in a share have a value in common among the rarest rest (1 - share) of each, so only these enter the lists (prefix filter).
  Values of common passages are the last to enter, and values that one class alone holds lead to no list.
* Short lists give all their pairs. Classes of long lists are mostly made of common content; they are listed again by their whole
  sets, where the same filter holds exactly for the threshold itself.
* Lists that are still long hold groups of near copies. Their classes are paired with a few pivots of the list; whatever is not yet
  connected then to the list's main component is paired with all of the list that is in other components. So a large group costs
  few pairs and yet no link between components is left out.

Candidates from the sketches' lists are filtered by the similarity of their union's sketch, and all are confirmed on their whole sets. A first round confirms one link
per class; the other candidates are confirmed only where they join different components. Components come from repeated minima with
shortcuts, each round written to the shared folder. Lists, links and components stay distributed.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.llm.common import byte_slices, staged

SLICE_BYTES = 1 << 20
K = 64
MISSED = 1e-6  # with what probability sets at the limit may have less of their sketches in common than `share_of` says
SHORT_LIST = 12
PIVOTS = 3
#: Places of texts are sent to all executors only up to this number (24 bytes each); beyond it the texts are joined by a shuffle.
MOST_SENT_PLACES = 1 << 19
PLACE = ["place", "place2"]

_WORDS: dict[bytes, int] = {}
REMEMBERED_WORDS = 1 << 18


def _mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit integers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes (63 bits) of the text's word shingles.

    A-Z are lower-cased; words are separated by space and \\t to \\r. Fewer words than `width` are one shingle; no word gives none.
    """
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: both follow ASCII only
    if not words:
        return np.empty(0, np.int64)
    new = set(words).difference(_WORDS)
    if len(_WORDS) + len(new) > REMEMBERED_WORDS:
        _WORDS.clear()
        new = set(words)
    for word in new:
        _WORDS[word] = xxhash.xxh3_64_intdigest(word)
    hashes = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    span = min(width, len(words))
    n = len(words) - span + 1
    out = np.full(n, span, np.uint64)
    for j in range(span):
        out = _mix(out + hashes[j:j + n])
    return np.unique(out >> np.uint64(1)).astype(np.int64)


def share_of(percent: int) -> int:
    """Percent of a sketch that sets at the limit have in common, but for a probability below MISSED (binomial tail)."""
    t, below, least = percent / 100, 0.0, 0
    while least < K and (below := below + comb(K, least) * t ** least * (1 - t) ** (K - least)) < MISSED:
        least += 1
    return 100 * least // K


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def placed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """id, text, and two hashes of the text that tell it from all others."""
    text = F.col(text_column)
    return docs.select(F.col(id_column).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("place"), F.xxhash64(F.lit(1), text).alias("place2"))


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """From id, text and its place: id, place, n (size of the set), sig (128-bit digest of the set, null if empty), values (sketch), brief (its upper 31 bits, in the same order)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                sets = [shingle_set(text, width) for text in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    *(part.column(c) for c in ("id", *PLACE)), pa.array([len(s) for s in sets], pa.int64()), pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([s[:K] for s in sets], pa.list_(pa.int64())), pa.array([(s[:K] >> 32).astype(np.int32) for s in sets], pa.list_(pa.int32())),
                ], names=["id", *PLACE, "n", "sig", "values", "brief"])

    return docs.mapInArrow(run, "id long, place long, place2 long, n long, sig binary, values array<long>, brief array<int>")


def class_texts(rows: DataFrame, classes: DataFrame, ids: DataFrame) -> DataFrame:
    """id (of the class) and text for the classes whose ids are given (a staged table of one column)."""
    wanted = classes.join(ids.withColumnRenamed(ids.columns[0], "id"), "id", "left_semi").select("id", *PLACE)
    wanted = staged(wanted, "wanted")
    if wanted.count() <= MOST_SENT_PLACES:
        wanted = F.broadcast(wanted)
    return rows.select("text", *PLACE).join(wanted, PLACE).dropDuplicates(["id"]).select("id", "text")


def whole_sets(docs: DataFrame, width: int) -> DataFrame:
    """From id and text: id, n, values (the whole set)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                sets = [shingle_set(text, width) for text in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["id", "n", "values"])

    return docs.mapInArrow(run, "id long, n long, values array<long>")


def prefix_lists(sets: DataFrame, percent: int) -> DataFrame:
    """From id, n, values: value, id, n, most, reach, m for the rarest values of each set, in lists of at least two ids.

    m is the list's length, `most` how many of the set's values any other set holds, and `reach` how many of its values are not rarer
    than this one. Sets that have `percent` of their values in common meet in at least one of these lists, first in that of their
    rarest common value, where both must reach far enough.
    """
    postings = sets.select("id", F.explode("values").alias("value"))
    common = postings.groupBy("value").agg(F.count("*").alias("m")).filter("m > 1")
    held = postings.join(common, "value").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("m", "value"))).alias("held"))
    sizes = sets.select("id", "n", F.size("values").alias("total"))
    alone = F.col("total") - F.size("held")  # values that no other set holds are the rarest
    room = F.col("total") - F.ceil(F.col("total") * percent / 100).cast("int") + 1 - alone
    entries = held.join(sizes, "id").filter(room > 0).select("id", "n", F.size("held").cast("long").alias("most"), F.posexplode(F.slice("held", F.lit(1), room)).alias("at", "entry"))
    entries = entries.select("id", "n", "most", (F.col("most") - F.col("at")).alias("reach"), F.col("entry.value").alias("value"))
    entries = staged(entries, "entries")
    lengths = entries.groupBy("value").agg(F.count("*").alias("m")).filter("m > 1")
    return entries.join(lengths, "value").select("value", "id", "n", "most", "reach", "m")


def _may_link(a: Column, b: Column, percent: int, bound: str) -> Column:
    """Whether two entries' sizes, and a bound of what each can share, allow a link: a link shares at least
    percent / (100 + percent) of both sizes together."""
    return (100 + percent) * F.least(a[bound], b[bound]) >= percent * (a["n"] + b["n"])


def short_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """All pairs a < b of the short lists whose sizes allow a link."""
    groups = lists.filter(F.col("m") <= SHORT_LIST).groupBy("value").agg(F.collect_list(F.struct("id", "n", "reach")).alias("ids"))  # at most SHORT_LIST
    later = lambda x: F.filter("ids", lambda y: (y["id"] > x["id"]) & _may_link(x, y, percent, "reach"))
    pairs = F.flatten(F.transform("ids", lambda x: F.transform(later(x), lambda y: F.struct(x["id"].alias("a"), y["id"].alias("b")))))
    return groups.select(F.inline(pairs)).distinct()


def pivot_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs of the ids of long lists with each of a few pivots of their list. The first pivot is the set with the fewest values of its
    own, which in a group of edited copies is the one closest to all others."""
    entry = F.struct("id", "n", "most")
    picks = [F.min_by(entry, F.struct(F.col("n") - F.col("most"), F.col("id"))), *(F.min_by(entry, F.xxhash64("id", F.lit(i))) for i in range(1, PIVOTS))]
    pivots = lists.groupBy("value").agg(F.array(*picks).alias("pivots"))
    pairs = lists.join(pivots, "value").select(entry.alias("x"), F.explode("pivots").alias("p")).filter((F.col("p.id") != F.col("x.id")) & _may_link(F.col("x"), F.col("p"), percent, "most"))
    return pairs.select(F.least("x.id", "p.id").alias("a"), F.greatest("x.id", "p.id").alias("b")).distinct()


def crossing_pairs(lists: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs within long lists of ids outside the list's main component with all ids of the list in another component than theirs."""
    placed = staged(with_label(lists.select("value", "id", "n", "reach"), labels, "id"), "placed")
    main = placed.groupBy("value", "label").agg(F.count("*").alias("c")).groupBy("value").agg(F.max_by("label", F.struct("c", "label")).alias("main"), F.count("*").alias("parts")).filter("parts > 1")
    outside = placed.join(main, "value").filter(F.col("label") != F.col("main")).select("value", F.struct("id", "n", "reach", "label").alias("x"))
    pairs = outside.join(placed.select("value", F.struct("id", "n", "reach", "label").alias("y")), "value").filter(
        (F.col("x.label") != F.col("y.label")) & _may_link(F.col("x"), F.col("y"), percent, "reach"))
    return pairs.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()


def estimated(pairs: DataFrame, classes: DataFrame, share: int) -> DataFrame:
    """Pairs whose union's sketch has at least `share` percent of its values in both."""
    side = lambda name: classes.select(F.col("id").alias(name), F.col("brief").alias(f"{name}_brief"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    union = F.slice(F.array_sort(F.array_union("a_brief", "b_brief")), 1, K)
    shared = F.size(F.array_intersect(F.array_intersect("a_brief", "b_brief"), union))
    return both.filter(100 * shared >= share * F.size(union)).select("a", "b")


def confirmed_by_sets(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose whole sets, which are at hand, are similar enough."""
    side = lambda name: sets.select(F.col("id").alias(name), F.col("values").alias(f"{name}_values"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    shared = F.size(F.array_intersect("a_values", "b_values"))
    return both.filter(100 * shared >= percent * (F.size("a_values") + F.size("b_values") - shared)).select("a", "b")


def confirmed(pairs: DataFrame, rows: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a staged table) whose whole sets are similar enough. Only the texts of classes in pairs are read into the joins."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "a_text", SLICE_BYTES):
                texts = zip(part.column("a_text").to_pylist(), part.column("b_text").to_pylist(), strict=True)
                ok = pa.array([similar(shingle_set(a, width), shingle_set(b, width), percent) for a, b in texts], pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column("a").filter(ok), part.column("b").filter(ok)], names=["a", "b"])

    ids = staged(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "paired")
    texts = class_texts(rows, classes, ids)
    side = lambda name: texts.select(F.col("id").alias(name), F.col("text").alias(f"{name}_text"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_text", "b_text").mapInArrow(run, "a long, b long")


def with_label(rows: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """Add the label of an id; an id without links is its own label."""
    known = labels.select(F.col("node").alias(column), F.col("label").alias("_label"))
    return rows.join(known, column, "left").withColumn("label", F.coalesce("_label", column)).drop("_label")


def components(links: DataFrame) -> DataFrame:
    """From links a, b: node and label, the smallest id that can be reached from it."""
    ways = staged(links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("w")).select("w.*").distinct(), "ways")
    labels = staged(ways.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = ways.join(labels, ways["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("least"))
        moved = labels.join(near, labels["node"] == near["a"]).select("node", F.col("label").alias("before"), F.least("label", "least").alias("label"))
        moved = staged(moved, "moved")
        beyond = moved.select(F.col("node").alias("label"), F.col("label").alias("further"))
        after = staged(moved.join(beyond, "label").select("node", "before", F.least("label", "further").alias("label")), "labels")
        labels = after.select("node", "label")
        if after.filter(F.col("before") != F.col("label")).isEmpty():
            return labels


def _grouped(docs: DataFrame, width: int, percent: int, id_column: str, text_column: str) -> DataFrame:
    """For every row: id, place, n, component (the smallest id of its group), kept."""
    rows = placed(docs, id_column, text_column)
    sets = staged(sketches(rows, width), "sets")
    classes = sets.filter("n > 0").groupBy("sig").agg(F.min("id").alias("doc"), F.min("n").alias("n"), F.any_value("values").alias("values"), F.any_value("brief").alias("brief"),
                                                      F.min(F.struct(*PLACE)).alias("at"))
    classes = staged(classes.select(F.monotonically_increasing_id().alias("id"), "sig", "doc", "n", "values", "brief", "at.*"), "classes")

    share = share_of(percent)
    lists = staged(prefix_lists(classes.select("id", "n", "values"), share), "lists").withColumns({"most": F.col("n"), "reach": F.col("n")})  # sketches give no bound for whole sets
    candidates = estimated(short_pairs(lists, percent), classes, share)
    crowded = staged(lists.filter(F.col("m") > SHORT_LIST).select("id").distinct(), "crowded")
    dense = None
    if not crowded.isEmpty():
        whole = staged(whole_sets(class_texts(rows, classes, crowded), width), "whole")
        again = staged(prefix_lists(whole, percent), "lists")
        dense = again.filter(F.col("m") > SHORT_LIST)
        candidates = candidates.union(short_pairs(again, percent)).union(pivot_pairs(dense, percent)).distinct()
    candidates = staged(candidates, "candidates")

    first = staged(candidates.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "first")
    links = staged(confirmed(first, rows, classes, width, percent).union(one_document(sets, classes)), "links")
    labels = components(links)
    with_both = with_label(with_label(candidates, labels, "a").withColumnRenamed("label", "a_label"), labels, "b")
    rest = staged(with_both.filter(F.col("a_label") != F.col("label")).select("a", "b").join(first, ["a", "b"], "left_anti"), "rest")
    if not rest.isEmpty():
        links = staged(links.union(confirmed(rest, rows, classes, width, percent)), "links")
        labels = components(links)
    if dense is not None:
        crossing = crossing_pairs(dense, labels, percent).join(candidates, ["a", "b"], "left_anti")
        found = staged(confirmed_by_sets(crossing, whole, percent), "found")
        if not found.isEmpty():
            labels = components(links.union(found))

    grouped = staged(with_label(classes.select("sig", "id", "doc", *PLACE), labels, "id"), "grouped")
    smallest = grouped.groupBy("label").agg(F.min("doc").alias("component"))
    # Where no row of a group has an id, one text of one class stands for it.
    alone = F.when((F.col("id") == F.col("label")), F.struct(*PLACE))
    known = grouped.join(smallest, "label").select("sig", "component", alone.alias("alone"))
    out = sets.select("id", *PLACE, "n", "sig").join(known, "sig", "left")
    nameless = F.col("component").isNull() & F.coalesce(F.col("alone") == F.struct(*PLACE), F.lit(False))
    kept = F.when(F.col("n") == 0, True).when(F.col("id").isNull(), nameless).otherwise(F.col("id") == F.col("component"))
    return out.select("id", *PLACE, "n", F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component")).alias("component"), kept.alias("kept"))


def one_document(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of different texts that have the same id."""
    named = sets.filter("n > 0 AND id IS NOT NULL").select(F.col("id").alias("doc"), "sig")
    several = named.groupBy("doc").agg(F.min("sig").alias("low"), F.max("sig").alias("high")).filter("low < high").select("doc")
    known = named.join(several, "doc").distinct().join(classes.select("sig", "id"), "sig").select("doc", "id")
    firsts = known.groupBy("doc").agg(F.min("id").alias("a"))
    return known.join(firsts, "doc").filter("a < id").select("a", F.col("id").alias("b"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 85, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Return id, n_shingles, component_id and kept for every row.

    Documents are linked if 100 * shared >= percent * united shingles; component_id is the smallest id that can be reached, and kept
    says that it is the row's own. A null text, or one without words, has 0 shingles and no link. Rows of one id are one document, whose
    texts are linked with each other. A row without an id links like any other: it is kept only if no row of its group has an id,
    component_id is then null, and of such a group the rows of one text are kept. Ids are whole numbers; another type is an error. An empty table gives
    an empty one; other columns are ignored.
    """
    id_type = _whole_number(docs, id_column)
    rows = _grouped(docs, width, percent, id_column, text_column)
    return rows.select(F.col("id").cast(id_type).alias(id_column), F.col("n").alias("n_shingles"), F.col("component").cast(id_type).alias("component_id"), "kept")


def _whole_number(docs: DataFrame, id_column: str) -> T.DataType:
    kind = docs.schema[id_column].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"{id_column} is of type {kind.simpleString()}: ids must be whole numbers")
    return kind


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 85, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows, with all their columns, that are kept (see `near_duplicates`); of rows without an id that have one text, one."""
    _whole_number(docs, id_column)
    marks = _grouped(docs, width, percent, id_column, text_column).filter(~F.col("kept")).select(F.col("id").alias("_id"), *(F.col(c).alias(f"_{c}") for c in PLACE)).distinct()
    marks = staged(marks, "dropped")
    if marks.count() <= MOST_SENT_PLACES:
        marks = F.broadcast(marks)
    rows = docs.select(F.struct("*").alias("row")).withColumns({"id": F.col(f"row.{id_column}"), "text": F.col(f"row.{text_column}")})
    rows = rows.select("row", "id", F.xxhash64("text").alias("place"), F.xxhash64(F.lit(1), "text").alias("place2"), F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)).alias("has_words"))
    left = rows.join(marks, rows["id"].eqNullSafe(marks["_id"]) & (rows["place"] == marks["_place"]) & (rows["place2"] == marks["_place2"]), "left_anti")
    once = left.filter("id IS NULL AND has_words").dropDuplicates(PLACE)
    return left.filter("id IS NOT NULL OR NOT has_words").unionByName(once).select("row.*")


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM (SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(list_slice(ws, i, i + 4), ' ')) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
k AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, k.component_id, d.doc_id = k.component_id AS kept FROM d LEFT JOIN n USING (doc_id) JOIN k ON k.a = d.doc_id
"""
