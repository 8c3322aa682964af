"""What several operators share: staged tables, byte-balanced slices of Arrow batches, safe places to split a text."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.session import work_dir

# The code points with the Unicode property White_Space, as a character class.
WHITE_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# Runs of white space with the run of other characters behind them. A byte-level BPE never joins a character that is not
# white space with a following one that is, so a text may be cut between any two of these matches without changing its ids.
SAFE_PIECE = re.compile(f"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+")

# The separators of words in the contracts: space and \t \n \v \f \r.
WORD_GAPS = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def staged(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it again: the lineage is cut and its size is known to the planner."""
    path = f"{work_dir(frame.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def byte_slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each slice holds about `most` bytes of text; a longer text is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if batch.num_rows > start:
        yield batch.slice(start)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with `value` computed once per row: a lambda's argument is a value, not an expression, so that no optimizer rule can
    copy the expression behind it into a loop over words."""
    return F.transform(F.array(value), use)[0]


def indices(first: int, last: Column) -> Column:
    """first..last, or nothing where last < first."""
    return F.when(last >= first, F.sequence(F.lit(first), last)).otherwise(F.array().cast("array<int>"))
