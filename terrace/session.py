"""Session settings the library relies on.

Only runtime SQL settings are touched, so the functions also work on a session somebody else built.
"""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Size-driven choices are left to adaptive execution: it broadcasts a join side only after measuring it,
# splits skewed join partitions (also when that costs one more exchange) and merges small partitions.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A stream join keeps one store per partition instead of four; its tables and their uploads are packed more tightly.
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def dealt_finely(df: DataFrame, *columns: str) -> DataFrame:
    """Rows dealt by columns into four times the usual number of partitions, where a task goes on to hold several hash tables of them."""
    return df.repartition(4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting for what is started in this context."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def work_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables.

    The cluster names it in spark.checkpoint.dir. Only where that is unset and the master is local, as in tests, a local
    folder is made and remembered; executors of a cluster would not see each other's files there.
    """
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = spark.conf.get("terrace.work.dir", None)
    if not local:
        local = tempfile.mkdtemp(prefix="terrace-")
        spark.conf.set("terrace.work.dir", local)
    return local
