"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Targets: sources share all words by weight, none beyond MOST_TIMES its size; what a source can't take is shared again by weight. Each
round is one aggregation over the sources, until no source is above its limit.

Quotas: the mix has a whole number of blocks of equal length. Blocks go to the highest quotients target / (2k + 1), first
to the sources, then within each source to its shards. A party's share minus what rounding can do is safe, so only the quotients around the
last seat, a few for each party, are written out, sorted by Spark and numbered.

Selection: a shard's documents follow a seeded hash, and their words make one stream that is cut into blocks and can be taken MOST_TIMES
times. A quota takes whole passes first, then the blocks of one more pass with the lowest seeded hashes. A document learns from its
place in the stream which of its words that is.

A source is dealt into shards of about SHARD_WORDS words by hash, so a source with a third of all rows is as many tasks as it needs; no
step holds a source, and nothing but the scalars of the rounds and one count for each partition reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import staged

GAPS = r"[\x20\x09-\x0D]+"
MOST_TIMES = 3
SHARD_WORDS = 1 << 17
BLOCK_WORDS = 512
#: Blocks are so short that the smallest target has this many.
LEAST_BLOCKS = 400


def n_words(text: Column) -> Column:
    return F.coalesce(F.size(F.array_remove(F.split(text, GAPS), "")), F.lit(0)).cast("long")


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add `place`, the number of a row in that order, from 0: rows are sorted in ranges, and the ranges' counts are added up."""
    held = staged(rows.orderBy(*order).withColumn("_mark", F.monotonically_increasing_id()), name)
    part = F.shiftright("_mark", 33)
    counts = sorted((r["part"], r["n"]) for r in held.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())  # one row per partition
    before, total = {}, 0
    for p, n in counts:
        before[p] = total
        total += n
    starts = F.lit([before.get(p, 0) for p in range(max(before, default=0) + 1)]).cast("array<bigint>")
    return held.withColumn("place", F.get(starts, part.cast("int")) + F.col("_mark").bitwiseAND((1 << 33) - 1)).drop("_mark")


def targets(sources: DataFrame, weight: Column, most_times: int = MOST_TIMES) -> DataFrame:
    """From a table with size (long): add weight and target (double)."""
    rows = sources.withColumn("weight", weight).withColumn("limit", F.col("size") * most_times)
    total = rows.agg(F.sum("size")).head()[0] or 0
    level, free = 0.0, F.lit(True)  # words for each unit of weight
    while True:
        open_weight, held = rows.agg(F.sum(F.when(free, F.col("weight"))), F.sum(F.when(~free, F.col("limit")))).head()
        after = (total - (held or 0)) / open_weight if open_weight else level
        if after == level:
            break
        level = after
        free = F.col("limit") > F.lit(level) * F.col("weight")
    return rows.withColumn("target", F.when(free, F.lit(level) * F.col("weight")).otherwise(F.col("limit").cast("double"))).drop("limit")


def apportion(parties: DataFrame, seats: DataFrame, group: list[str], party: str, name: str) -> DataFrame:
    """Sainte-Lague: add `quota` to parties (group columns, party, share), whose groups have `seats`.

    Of equal quotients the smaller party's counts first. Shares must be above 0.
    """
    sums = parties.groupBy(*group).agg(F.sum("share").alias("shares"), F.count("*").alias("parties")).join(seats, group)
    rows = staged(parties.join(sums, group), f"{name}-parties")
    # At a divisor d a party has round(share / d) seats, so all have shares / d seats but for half a seat each. At `low` that is enough
    # seats, and at `high` not too many; one more on either side covers what floating point can do.
    low = F.col("shares") / (F.col("seats") + F.col("parties"))
    high = F.when(2 * F.col("seats") > F.col("parties"), F.col("shares") / (F.col("seats") - F.col("parties") / 2))
    seats_at = lambda d: F.floor(F.col("share") / d + 0.5)
    rows = rows.withColumn("safe", F.greatest(F.coalesce(seats_at(high), F.lit(0)) - 1, F.lit(0)).cast("long"))
    last = F.greatest(seats_at(low) + 1, F.col("safe"))
    quotients = rows.select(*group, party, F.explode(F.sequence("safe", last)).alias("k"), "share").withColumn("quotient", F.col("share") / (2 * F.col("k") + 1))
    placed = numbered(quotients, [*(F.col(c) for c in group), F.desc("quotient"), F.col(party), F.col("k")], f"{name}-quotients")
    firsts = placed.groupBy(*group).agg(F.min("place").alias("first")).join(
        rows.groupBy(*group).agg((F.first("seats") - F.sum("safe")).alias("open")), group)
    won = placed.join(firsts, group).filter(F.col("place") < F.col("first") + F.col("open")).groupBy(*group, party).agg(F.count("*").alias("won"))
    return staged(rows.join(won, [*group, party], "left").select(*parties.columns, (F.col("safe") + F.coalesce("won", F.lit(0))).alias("quota")), f"{name}-quotas")


def block_hash(shard: Column, block: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), shard, block)


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), seed: int = 0, most_times: int = MOST_TIMES, block_words: int = BLOCK_WORDS,
                shard_words: int = SHARD_WORDS, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """Return id, source, size (words), source_size, target, block_words, passes and spans for every row.

    The mix takes a document `passes` times, and its words `spans` (array of first, last; from 0, both included) once more. Sources in
    code-point order, null last, weigh `weights`, repeating; a null source is a source of its own. A null or blank text has size 0 and
    is never taken. Repeated rows are documents of their own. The same rows and seed give the same mix. An empty table gives an empty one;
    other columns are ignored.
    """
    text = F.col(text_column)
    rows = staged(docs.select(F.col(id_column).alias("id"), F.col(source_column).alias("source"), n_words(text).alias("size"),
                              F.xxhash64(F.lit(seed), id_column, text_column).alias("mix"), F.xxhash64(F.lit(~seed), text_column, id_column).alias("mix2")), "sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("size"))
    sources = numbered(sources, [F.asc_nulls_last("source")], "sources").withColumnRenamed("place", "number")
    weight = F.get(F.array(*map(F.lit, weights)), F.pmod("number", F.lit(len(weights))).cast("int"))
    sources = staged(targets(sources, weight, most_times), "targets")
    total, least = sources.filter("target > 0").agg(F.sum("size"), F.min("target")).head()
    block = max(1, min(block_words, int((least or 0) / LEAST_BLOCKS)))
    whole = sources.filter("target > 0").select(F.pmod("number", F.lit(1)).alias("all"), "number", F.col("target").alias("share"))  # one group, by a column: a literal would make the joins cross joins
    seats = whole.select("all").distinct().withColumn("seats", F.lit(round((total or 0) / block)).cast("long"))
    quotas = apportion(whole, seats, ["all"], "number", "sources")

    known = sources.select("source", "number", F.col("size").alias("source_size"), "target", F.ceil(F.col("size") / shard_words).alias("shards"))
    placed = rows.join(known, rows["source"].eqNullSafe(known["source"])).drop(known["source"])
    shard = F.when(F.col("size") > 0, F.pmod(F.xxhash64("mix", "mix2"), F.col("shards")))
    placed = staged(placed.withColumn("shard", shard), "placed")
    shards = placed.filter("size > 0").groupBy("number", "shard").agg(F.sum("size").alias("words"), F.first("source_size").alias("source_size"))
    parties = shards.join(quotas.select("number", F.col("share").alias("target")), "number").select("number", "shard", "words", (F.col("target") * F.col("words") / F.col("source_size")).alias("share"))
    shards = apportion(staged(parties, "shards"), quotas.select("number", F.col("quota").alias("seats")), ["number"], "shard", "shards")

    # The last block of a shard is shorter, so passes are counted in words; what is beyond them is whole blocks again.
    blocks, quota = F.ceil(F.col("words") / block), F.least(F.col("quota") * block, F.col("words") * most_times)
    passes = F.floor(quota / F.col("words"))
    more = F.least(F.round((quota - passes * F.col("words")) / block).cast("long"), blocks)
    taken = shards.select("number", "shard", passes.alias("passes"), more.alias("more"), F.xxhash64("number", "shard").alias("key"), blocks.alias("blocks"))
    hashes = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda b: block_hash(F.col("key"), b, seed))
    bound = F.when(F.col("more") > 0, F.get(F.array_sort(hashes), (F.col("more") - 1).cast("int")))
    taken = taken.select("number", "shard", "passes", "key", bound.alias("bound"))

    end = F.sum("size").over(Window.partitionBy("number", "shard").orderBy("mix", "mix2", "size").rowsBetween(Window.unboundedPreceding, 0))
    words = placed.filter("size > 0").withColumn("end", end).join(taken, ["number", "shard"])
    words = words.withColumns({"from": F.col("end") - F.col("size")})
    words = words.withColumns({"low": F.floor(F.col("from") / block), "high": F.floor((F.col("end") - 1) / block)})
    chosen = lambda b: block_hash(F.col("key"), b, seed) <= F.col("bound")
    inside = F.sequence("low", "high")
    opens = F.filter(inside, lambda b: chosen(b) & ((b == F.col("low")) | ~chosen(b - 1)))  # blocks that follow each other are one span
    closes = F.filter(inside, lambda b: chosen(b) & ((b == F.col("high")) | ~chosen(b + 1)))
    spans = F.zip_with(opens, closes, lambda a, b: F.struct(F.greatest(a * block - F.col("from"), F.lit(0)).cast("long").alias("first"),
                                                             F.least((b + 1) * block - 1 - F.col("from"), F.col("size") - 1).cast("long").alias("last")))
    none = F.array().cast("array<struct<first:long,last:long>>")
    spans = F.when(F.col("bound").isNull(), none).otherwise(spans)
    columns = ["id", "source", "size", "source_size", "target"]
    out = words.select(*columns, "passes", spans.alias("spans")).unionByName(
        placed.filter("size = 0").select(*columns, F.lit(0).cast("long").alias("passes"), none.alias("spans")))
    return out.select(F.col("id").alias(id_column), "source", "size", "source_size", "target", F.lit(block).cast("long").alias("block_words"), "passes", "spans")


def taken_words() -> Column:
    """How many words the mix takes of a document, repeats counted."""
    return F.col("passes") * F.col("size") + F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)


def mixed_words(docs: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """Return id, size, source_size, target and taken (words, repeats counted) for every row; see `mix_sources`."""
    return mix_sources(docs, id_column=id_column, **options).select(id_column, "size", "source_size", "target", taken_words().alias("taken"))
