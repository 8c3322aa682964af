"""Sinks: partition overwrite, idempotent append, staged replacement, tab-delimited text."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.session import work_dir

OPEN_DATE = "9999-12-31"  # fixed value: partition of rows that are still open


def write_partitions(df: DataFrame, path: str, part: str = "dt", fmt: str = "parquet") -> None:
    """Overwrite only the partitions that `df` contains.

    The rebalance hint gathers each partition's rows into files of the advisory size: small partitions share a
    task and a partition that holds most of the rows is split over many.
    """
    (df.hint("rebalance", part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(part).format(fmt).save(path))


def replace_partitions(spark: SparkSession, df: DataFrame, path: str, part: str = "dt", fmt: str = "parquet", emptied: Sequence[str] = ()) -> None:
    """write_partitions for a frame that was itself read from `path`: staged first, then swapped in.

    `emptied` names partitions that were read and may hold no row any more, such as that of the open rows of a history;
    those that `df` has no row for are left empty.
    """
    staged = f"{work_dir(spark)}/staged-{uuid.uuid4().hex}"
    df.write.format(fmt).save(staged)
    rows = spark.read.schema(df.schema).format(fmt).load(staged)
    write_partitions(rows, path, part, fmt)
    for value in emptied:
        if rows.where(F.col(part) == value).isEmpty():
            rows.drop(part).limit(0).write.mode("overwrite").format(fmt).save(f"{path}/{part}={value}")


def append_missing(spark: SparkSession, new: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Add report rows that `path` does not hold yet; running it twice changes nothing.

    History is neither rewritten nor shuffled whole: the (small) new rows are anti-joined against it.
    """
    from terrace.operators.combine import missing_rows

    new = new.distinct()
    history = stored(spark, path, new.schema, fmt)
    if history is not None:
        new = missing_rows(new, history)
    new.write.mode("append").format(fmt).save(path)
    return spark.read.schema(new.schema).format(fmt).load(path)


def stored(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame | None:
    """The table at `path`, or None when nothing has been written there yet."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def insert_partitions(df: DataFrame, table: str) -> None:
    """Overwrite the partitions of a catalog table that `df` contains; columns are matched by name."""
    spark = df.sparkSession
    (df.select(*spark.table(table).columns).write.option("partitionOverwriteMode", "dynamic").insertInto(table, overwrite=True))


def save_table(df: DataFrame, table: str, part: str | None = "dt", fmt: str = "parquet") -> None:
    """Replace a whole catalog table, partitioned by `part` where it is given; the catalog knows its partitions at once."""
    writer = df.write.mode("overwrite").format(fmt)
    (writer.partitionBy(part) if part else writer).saveAsTable(table)


def register_table(spark: SparkSession, table: str, path: str, schema: str, part: str = "dt", fmt: str = "parquet") -> None:
    """Make partition folders at `path` known to the catalog, and find the ones added since."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schema}, {part} STRING) USING {fmt} PARTITIONED BY ({part}) LOCATION '{path}'")
    spark.catalog.recoverPartitions(table)


def write_text_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Report layer as tab-delimited text."""
    df.write.mode(mode).csv(path, sep="\t", nullValue="\\N", quote="", emptyValue="")


def append_text_rows(spark: SparkSession, new: DataFrame, path: str) -> None:
    """Add the rows of a report that its text table does not hold yet; its history stays."""
    from terrace.operators.combine import missing_rows

    new = new.distinct()
    try:
        history = spark.read.schema(new.schema).csv(path, sep="\t", nullValue="\\N", quote="", mode="FAILFAST")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        history = None
    write_text_table(new if history is None else missing_rows(new, history), path, "append")


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Row count as a side effect of the write itself, instead of an extra counting job before it."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
