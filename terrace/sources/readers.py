"""Scans: columnar partitions, tab-delimited text, file and message streams. Schemas are always explicit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Input tables of the queries. Timestamps carry no zone in the files; they are declared as TIMESTAMP, which is
# read as UTC, so that predicates on them still reach the parquet scan and withWatermark accepts them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp",
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Batch scan of one input table with its declared schema."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def stream(spark: SparkSession, path: str, schema: str | T.StructType, files_per_trigger: int | None = None,
           fmt: str = "parquet", **options: str) -> DataFrame:
    """Streaming scan. `path` may be a folder or a glob; `fmt` may be any registered streaming source.

    With fmt="kafka" (its connector on the class path) the payload is returned as a non-null string `value`.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        return reader.load().select(F.col("value").cast("string").alias("value")).where("value is not null")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.schema(schema).load(path)


def stream_table(spark: SparkSession, sf_dir: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """One input table as a stream. The glob matches a single file as well as a folder of parts."""
    return stream(spark, f"{sf_dir}/{name}.parquet*", SCHEMAS[name], files_per_trigger)


def read_partition(spark: SparkSession, path: str, schema: str, dt: str, fmt: str = "orc", part: str = "dt") -> DataFrame:
    """Scan one `dt` partition of a partitioned table; the predicate prunes folders."""
    return spark.read.format(fmt).schema(f"{schema}, {part} string").load(path).where(F.col(part) == F.lit(dt))


def read_text_table(spark: SparkSession, path: str, schema: str, null_value: str = "\\N") -> DataFrame:
    """Tab-delimited text table (raw and report layers)."""
    return spark.read.schema(schema).csv(path, sep="\t", nullValue=null_value, quote="", mode="FAILFAST")
