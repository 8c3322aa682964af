"""Names to frames: raw tables come from a reader, stored layers from storage, the rest from their jobs."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators.dims import latest_partition
from terrace.session import tune
from terrace.sources import SCHEMAS, append_text_rows, load, replace_partitions, write_partitions
from terrace.sources.writers import OPEN_DATE


class Warehouse:
    """`w["dws_..."]` is the frame of that table as of a day.

    Run layer by layer in production: publish() each table and pass the stored ones as `stored`, so a report reads
    yesterday's rollups instead of recomputing them. Without stored layers a report is one plan over the raw tables.
    Of a stored table that holds a whole snapshot per dt, only one is read: of a dimension the newest that is not after today, of n-day and to-date rollups
    today's.
    """

    def __init__(self, raw: Callable[[str], DataFrame], jobs: Mapping[str, Callable[["Warehouse"], DataFrame]], as_of: date,
                 stored: Mapping[str, DataFrame] | None = None):
        self.as_of, self._raw, self._jobs = as_of, raw, jobs
        self._stored = dict(stored or {})
        self._frames = {name: self._snapshot(name, self.today) for name in self._stored}

    def _snapshot(self, name: str, day: str) -> DataFrame:
        frame = self._stored[name]
        if "dt" not in frame.columns:
            return frame
        if name.startswith("dim_") and not name.endswith("_zip"):
            return latest_partition(frame.where(F.col("dt") <= F.lit(day)))
        return frame.where(F.col("dt") == F.lit(day)) if name.endswith(("_nd", "_td")) else frame

    def stored(self, name: str) -> DataFrame | None:
        """All of a stored table, or None where the table is not stored."""
        return self._stored.get(name)

    def before(self, name: str) -> tuple[str, DataFrame] | None:
        """The newest snapshot that a stored table holds of a day before today, and that day; None where there is none.

        Days between were not published, so what starts from the snapshot has to add all of them.
        """
        if name not in self._stored:
            return None
        frame = self._stored[name]
        day = frame.where(F.col("dt") < F.lit(self.today)).agg(F.max("dt")).head()[0]
        return (str(day), frame.where(F.col("dt") == F.lit(day))) if day is not None else None

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._jobs[name](self) if name in self._jobs else self._raw(name)
        return self._frames[name]

    @property
    def today(self) -> str:
        return self.as_of.isoformat()

    def days_ago(self, n: int) -> str:
        return (self.as_of - timedelta(days=n)).isoformat()

    def publish(self, name: str, root: str, fmt: str = "orc") -> None:
        """Compute today's rows of a table and write them: dimensions, facts and rollups by dt partition, reports as tab-delimited text.

        A report's table keeps the rows of earlier days; publishing a day twice adds nothing. Histories and accumulating facts are
        made from their own stored rows, so they are staged first, and the partition of open rows is emptied if none are left.
        """
        frame = self._jobs[name](self)
        if name.startswith("ads_"):
            append_text_rows(frame.sparkSession, frame, f"{root}/{name}")
        elif name.endswith(("_zip", "_acc")):
            replace_partitions(frame.sparkSession, frame, f"{root}/{name}", fmt=fmt, emptied=[OPEN_DATE])
        else:
            write_partitions(frame if "dt" in frame.columns else frame.withColumn("dt", F.lit(self.today)), f"{root}/{name}", fmt=fmt)


def derived_reader(spark: SparkSession, sf_dir: str, raw: Mapping[str, str]) -> Callable[[str], DataFrame]:
    """Raw tables as statements over the given tables."""
    tune(spark)

    def read(name: str) -> DataFrame:
        used = {t: load(spark, sf_dir, t) for t in SCHEMAS if "{" + t + "}" in raw[name]}
        return spark.sql(raw[name], **used) if used else spark.sql(raw[name])
    return read


def job_table() -> tuple[dict, Callable]:
    jobs: dict[str, Callable[[Warehouse], DataFrame]] = {}

    def job(fn):
        jobs[fn.__name__] = fn
        return fn
    return jobs, job
