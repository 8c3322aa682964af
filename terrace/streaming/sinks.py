"""Streaming sinks: upsert by key, date folders, routing of change records, JSON rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.functions.text import snake_case
from terrace.functions.time import epoch_normalise
from terrace.sources.writers import stored


def batch_log(path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer of all rows, a folder per micro-batch: nothing stored is rewritten, and a repeated batch replaces itself."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


def read_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows that batch_log has written."""
    rows = stored(spark, path, schema)
    return rows.select(*schema.fieldNames()) if rows is not None else spark.createDataFrame([], schema)


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key by an aggregation over structs, combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "_newest.*").select(*df.columns)


class KeyedTable:
    """A table with one row per key, fed with upserts and deletes by micro-batches.

    A micro-batch adds a folder with its newest row per key, at level 0; rows with `_deleted` true take their key away. As soon as `fold` folders of
    a level are there, they become one folder of the next level, so a table that took n batches lies in less than 2 * fold * log(n) folders, of which a read opens at most fold for each level;
    each row is rewritten once per level. A delete mark goes when its fold has nothing older beside it and `marks` batches have passed, so that an older version
    that comes later stays deleted. Folders name the batch they reach up to: a batch or a fold that runs again
    after a failure replaces itself, and folders without a success mark do not count. Folded folders stay until the next fold of their
    level, for readers that have begun.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, keys: Sequence[str], order: Sequence[str] = (), fold: int = 8, marks: int = 1000):
        fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
        self.schema = T.StructType([f for f in fields if f.name != "_deleted"])
        self.spark, self.path, self.keys, self.order, self.fold, self.marks = spark, path, list(keys), list(order), fold, marks
        self.stored = T.StructType([*self.schema.fields, T.StructField("_deleted", T.BooleanType()), T.StructField("_batch", T.LongType())])

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _folders(self) -> dict[int, list[int]]:
        """For each level the batches that its complete folders reach up to."""
        found: dict[int, list[int]] = {}
        fs, at = self._fs(f"{self.path}/level=*/upto=*/_SUCCESS")
        for status in fs.globStatus(at) or []:
            level, upto = (int(part.split("=")[1]) for part in status.getPath().getParent().toString().split("/")[-2:])
            found.setdefault(level, []).append(upto)
        return {level: sorted(uptos) for level, uptos in found.items()}

    @staticmethod
    def _covered(folders: dict[int, list[int]], level: int) -> int:
        """The batch up to which folders of this level are folded into higher ones."""
        return max((uptos[-1] for above, uptos in folders.items() if above > level), default=-1)

    def current(self) -> list[tuple[int, int]]:
        """The folders that a read opens."""
        folders = self._folders()
        return [(level, upto) for level, uptos in sorted(folders.items()) for upto in uptos if upto > self._covered(folders, level)]

    def _rows(self, folders: Sequence[tuple[int, int]]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.stored)
        rows = self.spark.read.schema(self.stored).parquet(*[f"{self.path}/level={level}/upto={upto}" for level, upto in folders])
        return newest_per_key(rows, self.keys, [*self.order, "_batch"]) if len(folders) > 1 else rows

    def read(self) -> DataFrame:
        """The table as it stands."""
        return self._rows(self.current()).where("not _deleted").select(*self.schema.fieldNames())

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """foreachBatch writer."""
        rows = batch if "_deleted" in batch.columns else batch.withColumn("_deleted", F.lit(False))
        rows = rows.select(*self.schema.fieldNames(), F.coalesce("_deleted", F.lit(False)).alias("_deleted"), F.lit(batch_id).cast("long").alias("_batch"))
        newest_per_key(rows, self.keys, [*self.order, "_batch"]).write.mode("overwrite").parquet(f"{self.path}/level=0/upto={batch_id}")
        level = 0
        while True:
            folders = self._folders()
            covered = self._covered(folders, level)
            waiting = [upto for upto in folders.get(level, []) if upto > covered]
            if len(waiting) < self.fold:
                return
            rows = self._rows([(level, upto) for upto in waiting])
            if not any(above > level for above in folders):
                rows = rows.where(~F.col("_deleted") | (F.col("_batch") > waiting[-1] - self.marks))
            rows.write.mode("overwrite").parquet(f"{self.path}/level={level + 1}/upto={waiting[-1]}")
            for upto in folders[level]:
                if upto <= covered:
                    fs, at = self._fs(f"{self.path}/level={level}/upto={upto}")
                    fs.delete(at, True)
            level += 1


def additive_log(path: str, ts: str, size: str, keys: Sequence[str], sums: Mapping[str, str]) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer of windowed sums that are visible after every micro-batch.

    A batch is summed per window and key and stored under its own batch folder; read_additive() adds the batches up. The
    stream itself holds no window state, and a repeated batch replaces itself.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.groupBy(F.window(ts, size).alias("window"), *keys).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
         .write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}"))
    return write


def read_additive(spark: SparkSession, path: str, keys: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    rows = spark.read.parquet(path)
    return rows.groupBy("window", *keys).agg(*[F.sum(n).alias(n) for n in sums])


def dated_rows(df: DataFrame, epoch: str, tz: str | None = None) -> DataFrame:
    """Adds day=yyyyMMdd from epoch seconds or milliseconds; rows without a usable time go to error_bucket."""
    return df.withColumn("day", F.coalesce(F.date_format(epoch_normalise(F.col(epoch), "auto", tz), "yyyyMMdd"), F.lit("error_bucket")))


def dated_sink(df: DataFrame, epoch: str, path: str, checkpoint: str, tz: str | None = None):
    """Start a text sink (one JSON row per line) in day folders."""
    rows = dated_rows(df, epoch, tz)
    return (rows.select("day", F.to_json(F.struct(*df.columns)).alias("value")).writeStream.partitionBy("day").format("text")
            .option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def route_dims(cdc: DataFrame, config: DataFrame, deletes: bool = False) -> DataFrame:
    """Change records with the dimension table each belongs to.

    config: source_table, sink_table, sink_row_key, sink_columns (comma list, null for all). Tables that are not configured
    are dropped, and deletes unless `deletes`, which marks them in `_deleted`. One row per record: sink_table, row_key, values, ts_ms.
    """
    row = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after")) if deletes else F.col("after")
    named = (cdc if deletes else cdc.where("op <> 'd'")).withColumns({"source_table": F.col("source")["table"], "_row": row})
    joined = named.join(config, "source_table")
    wanted = F.when(F.col("sink_columns").isNull(), F.col("_row")).otherwise(
        F.map_filter("_row", lambda k, _: F.array_contains(F.split("sink_columns", ","), k)))
    return joined.select("sink_table", F.expr("_row[sink_row_key]").alias("row_key"), wanted.alias("values"), "ts_ms", *([(F.col("op") == "d").alias("_deleted")] if deletes else []))


class LateSide:
    """foreachBatch writer of the rows of a source that come behind its watermark: the newest time of all micro-batches before, less `delay`.

    Run it as a job of its own beside the one that drops such rows; that one holds a micro-batch's rows against the watermark of the micro-batch
    before, so it may still take some of these. The newest time is kept per micro-batch, so one that runs again
    finds the same rows.
    """

    def __init__(self, spark: SparkSession, root: str, ts: str, delay: str):
        self.spark, self.root, self.ts, self.delay = spark, root, ts, delay
        self.newest = KeyedTable(spark, f"{root}/newest", "turn int, newest timestamp", ["turn"])

    def write(self, batch: DataFrame, batch_id: int) -> None:
        before = self.newest.read().where(F.col("turn") == (batch_id + 1) % 2).head()  # of the batch before
        limit = F.lit(before["newest"] if before else None).cast("timestamp")
        batch.where(F.col(self.ts) < limit - F.expr(f"INTERVAL {self.delay}")).write.mode("overwrite").parquet(f"{self.root}/late/batch_id={batch_id}")
        self.newest.write(batch.agg(F.greatest(F.max(self.ts), limit).alias("newest")).select(F.lit(batch_id % 2).alias("turn"), "newest"), batch_id)

    def read(self, schema: T.StructType) -> DataFrame:
        return read_log(self.spark, f"{self.root}/late", schema)


CONFIG_SCHEMA = "source_table string, sink_table string, sink_row_key string, sink_columns string, ts_ms bigint"
ROUTED_SCHEMA = "sink_table string, row_key string, values map<string,string>, ts_ms bigint"


class DimRouter:
    """foreachBatch writer of a stream of change records (`stream` = data) and changes of the routing configuration (config).

    A micro-batch first brings the configuration up to date, then routes its records by it: what is configured, or no longer configured, from some batch
    on holds for the records of that and later batches. Both are keyed tables, so configuration, rows and deletes survive a restart.
    """

    def __init__(self, spark: SparkSession, root: str, fold: int = 8):
        self.config = KeyedTable(spark, f"{root}/config", CONFIG_SCHEMA, ["source_table"], ["ts_ms"], fold)
        self.rows = KeyedTable(spark, f"{root}/rows", ROUTED_SCHEMA, ["sink_table", "row_key"], ["ts_ms"], fold)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        row = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
        config = batch.where("stream = 'config'").select(*(row[c].alias(c) for c in ("source_table", "sink_table", "sink_row_key", "sink_columns")), "ts_ms", (F.col("op") == "d").alias("_deleted"))
        self.config.write(config, batch_id)
        self.rows.write(route_dims(batch.where("stream = 'data'"), self.config.read().drop("ts_ms"), deletes=True), batch_id)

    def read(self, sink_table: str) -> DataFrame:
        return self.rows.read().where(F.col("sink_table") == sink_table)


def kafka_sink(df: DataFrame, servers: str, topic: str, checkpoint: str, key: str | None = None):
    """Start a JSON sink into a topic (the connector must be on the class path). Delivery is at least once; rows with a
    key land in the key's partition, so a compacted topic keeps the newest row per key."""
    value = F.to_json(F.struct(*df.columns)).alias("value")
    rows = df.select(F.col(key).cast("string").alias("key"), value) if key else df.select(value)
    return (rows.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).option("kafka.acks", "all")
            .option("kafka.enable.idempotence", "true").option("checkpointLocation", checkpoint).start())


def to_snake_json(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Rows as JSON documents with snake_case names."""
    columns: list[Column] = [F.col(c).alias(snake_case(c)) for c in df.columns if c not in exclude]
    return df.select(F.to_json(F.struct(*columns)).alias("value"))


def json_batches(path: str, exclude: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer of JSON rows, a folder of text per micro-batch, as a bulk load with the batch as its label takes them: loading a label twice
    changes nothing."""
    def write(batch: DataFrame, batch_id: int) -> None:
        to_snake_json(batch, exclude).write.mode("overwrite").text(f"{path}/batch_id={batch_id}")
    return write
