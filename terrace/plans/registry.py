from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from terrace.plans import job_queries, live_queries, operator_queries, stream_queries

    return {**operator_queries.QUERIES, **job_queries.QUERIES, **stream_queries.QUERIES,
            **live_queries.QUERIES}
