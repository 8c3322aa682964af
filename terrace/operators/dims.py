"""Dimension building.

No join here carries a broadcast hint: dimension sizes are the caller's, so Spark measures them and broadcasts
those below its threshold, and sort-merges (with skew splitting) the others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.sources.writers import OPEN_DATE


def star_flatten(fact: DataFrame, dims: Sequence[tuple[DataFrame, str, str, Mapping[str, str]]], how: str = "left") -> DataFrame:
    """Join dimensions one after the other: (frame, key of the frame so far, key of the dimension, column -> name).

    A later step may use a column that an earlier one brought in, so chains (sku -> category3 -> category2) are
    written in order. Each dimension is cut to its key and the wanted columns first.
    """
    out = fact
    for i, (dim, left_key, dim_key, columns) in enumerate(dims):
        key = f"_k{i}"
        side = dim.select(F.col(dim_key).alias(key), *[F.col(c).alias(n) for c, n in columns.items()])
        out = out.join(side, F.col(left_key) == F.col(key), how).drop(key)
    return out


def fold_set(df: DataFrame, key: str, fields: Mapping[str, Column], name: str) -> DataFrame:
    """Child rows of a key as one sorted array of structs (attributes of a product, couriers of an area)."""
    item = F.struct(*[c.alias(n) for n, c in fields.items()])
    # A product's attributes are the row itself in the output, so the array is as long as the row must be;
    # equal children are removed before the shuffle.
    return df.select(key, item.alias("_item")).distinct().groupBy(key).agg(F.array_sort(F.collect_list("_item")).alias(name))


def dict_decode(df: DataFrame, dictionary: DataFrame, code: str, name: str, parent: str | None = None,
                dic_code: str = "dic_code", dic_name: str = "dic_name") -> DataFrame:
    """Add the dictionary name of a code; an unknown code gives null."""
    if parent is not None:
        dictionary = dictionary.where(F.col("parent_code") == parent)
    side = dictionary.select(F.col(dic_code).cast("string").alias("_code"), F.col(dic_name).alias(name))
    return df.join(side, F.col(code).cast("string") == F.col("_code"), "left").drop("_code")


def scd2_init(snapshot: DataFrame, start: Column) -> DataFrame:
    """First load of a history table: every row open."""
    return snapshot.withColumn("start_date", start).withColumn("end_date", F.lit(OPEN_DATE))


def scd2_merge(history: DataFrame, changes: DataFrame, key: str, tracked: Sequence[str], as_of: date) -> DataFrame:
    """Merge one day's rows (one per key) into a history table.

    Closed intervals stay as they are. An open row is closed on the day before only if a tracked column really
    changed, and then its successor opens today. The open rows are joined once; each pair gives one or two rows.
    """
    columns = history.columns
    still_open = F.col("end_date") == OPEN_DATE
    old = history.where(still_open).select(F.struct(*columns).alias("_old"), F.col(key).alias("_old_key"))
    new = (changes.withColumn("start_date", F.lit(as_of.isoformat())).withColumn("end_date", F.lit(OPEN_DATE))
           .select(F.struct(*[F.col(c).cast(history.schema[c].dataType).alias(c) for c in columns]).alias("_new"),
                   F.col(key).alias("_new_key")))
    same = F.lit(True)
    for c in tracked:
        same = same & F.col("_old")[c].eqNullSafe(F.col("_new")[c])
    closed_now = F.col("_old").withField("end_date", F.lit((as_of - timedelta(days=1)).isoformat()))
    rows = (F.when(F.col("_new_key").isNull() | (F.col("_old_key").isNotNull() & same), F.array("_old"))
            .when(F.col("_old_key").isNull(), F.array("_new")).otherwise(F.array(closed_now, F.col("_new"))))
    merged = old.join(new, F.col("_old_key") == F.col("_new_key"), "full").select(F.inline(rows))
    return merged.select(*columns).unionByName(history.where(~still_open))


def hierarchy_resolve(node: DataFrame, tree: DataFrame, level: str, region: str, node_id: str = "id",
                      parent: str = "parent_id", name: str = "name", province: bool = True) -> DataFrame:
    """City and province of an organisation whose region is a city (level 1) or a district (deeper levels).

    Adds city_id, city_name and, unless `province` is False, province_id and province_name. The tree is the region
    table, joined once per step up.
    """
    up = {"_n1": region, "_n2": "_n1_parent", **({"_n3": "_n2_parent"} if province else {})}
    out = node
    for alias, key in up.items():
        side = tree.select(F.col(node_id).alias(f"{alias}_id"), F.col(name).alias(f"{alias}_name"),
                           F.col(parent).alias(f"{alias}_parent"))
        out = out.join(side, F.col(key) == F.col(f"{alias}_id"), "left")
    at_city = F.col(level) == 1
    picked = {"city_id": ("_n1_id", "_n2_id"), "city_name": ("_n1_name", "_n2_name")}
    if province:
        picked |= {"province_id": ("_n2_id", "_n3_id"), "province_name": ("_n2_name", "_n3_name")}
    return out.select(*node.columns, *[F.when(at_city, F.col(a)).otherwise(F.col(b)).alias(n) for n, (a, b) in picked.items()])


def date_spine(spark: SparkSession, start: date, end: date) -> DataFrame:
    """Calendar rows from start to end, generated on the executors."""
    days = spark.range(0, (end - start).days + 1).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("d"))
    return days.select(
        F.date_format("d", "yyyy-MM-dd").alias("date_id"), F.weekofyear("d").alias("week_id"),
        (F.weekday("d") + 1).alias("week_day"), F.dayofmonth("d").alias("day"), F.month("d").alias("month"),
        F.quarter("d").alias("quarter"), F.year("d").alias("year"), (F.weekday("d") < 5).alias("is_workday"))


def latest_partition(dim: DataFrame, part: str = "dt") -> DataFrame:
    """Rows of the newest partition. The maximum is one row, so it is joined as a broadcast of one row."""
    newest = dim.agg(F.max(part).alias("_newest"))
    return dim.join(F.broadcast(newest), F.col(part) == F.col("_newest")).drop("_newest")
