"""Source tables with date scoping that reaches the scan.

Operators receive plain DataFrames. A ``Tables`` object hands them out
already restricted to a date scope in the way the physical layout allows:
partition filters for lake tables, pushed-down time ranges for the stand-in.
The operators then apply the exact date test themselves, so a source may
return a superset.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from watchpath.functions.dates import DateScope


class Tables:
    """Interface: ``clickstream(start, end)`` and ``video(start, end)``."""

    spark: SparkSession

    def clickstream(self, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
        raise NotImplementedError

    def video(self, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
        raise NotImplementedError

    def days(self) -> tuple[list[dt.date], list[dt.date]]:
        """The days that the clickstream and the viewing table hold, rising."""
        raise NotImplementedError

    def scope(self) -> DateScope:
        """First to last day of both tables."""
        clicks, views = self.days()
        both = sorted({*clicks, *views})
        if not both:
            raise ValueError("the tables hold no day")
        return DateScope.between(both[0], both[-1])


def partition_days(spark: SparkSession, name: str, column: str, source: str = "parquet") -> list[dt.date]:
    """Days of a date-partitioned table, from its folders or the catalogue: no file is read."""
    if source == "table":
        values = [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    else:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        values = [s.getPath().getName() for s in fs.listStatus(where)]
    parts = [p.removeprefix(f"{column}=") for v in values for p in v.split("/") if p.startswith(f"{column}=")]
    return sorted({dt.date.fromisoformat(p) for p in parts if not p.startswith("__HIVE")})


@dataclass
class LakeTables(Tables):
    """Date-partitioned Parquet (or catalog) tables.

    ``clickstream`` is partitioned by the Eastern event date
    ``adobe_date_est``; ``video`` by ``adobe_date``. Filters on those columns
    become partition filters, so only the scoped days are listed and read.
    The click scope is padded by a day on each side because the exact test
    uses the date derived from the GMT hit time.
    """

    spark: SparkSession
    clickstream_path: str
    video_path: str
    click_date_col: str = "adobe_date_est"
    video_date_col: str = "adobe_date"
    source: str = "parquet"          # "parquet": paths; "table": catalog table names

    def __post_init__(self):
        if self.source not in ("parquet", "table"):
            raise ValueError(f"unknown source {self.source!r}")
        self._frames: dict[str, DataFrame] = {}

    def _read(self, name: str) -> DataFrame:
        """The table's DataFrame, resolved once per ``LakeTables`` (listing,
        partition discovery and footers are read once; filters are added per call)."""
        if name not in self._frames:
            reader = self.spark.read.parquet if self.source == "parquet" else self.spark.table
            self._frames[name] = reader(name)
        return self._frames[name]

    def days(self) -> tuple[list[dt.date], list[dt.date]]:
        return (partition_days(self.spark, self.clickstream_path, self.click_date_col, self.source),
                partition_days(self.spark, self.video_path, self.video_date_col, self.source))

    def clickstream(self, start=None, end=None) -> DataFrame:
        df = self._read(self.clickstream_path)
        if start is not None:
            df = df.where(F.col(self.click_date_col) >= F.lit(start - dt.timedelta(days=1)))
        if end is not None:
            df = df.where(F.col(self.click_date_col) <= F.lit(end + dt.timedelta(days=1)))
        return df

    def video(self, start=None, end=None) -> DataFrame:
        df = self._read(self.video_path)
        if start is not None:
            df = df.where(F.col(self.video_date_col) >= F.lit(start))
        if end is not None:
            df = df.where(F.col(self.video_date_col) <= F.lit(end))
        return df
