"""Keep the attributed store current as new source files land.

The daily scripts recompute "yesterday" on a schedule. Here a Structured
Streaming file source watches the partitioned clickstream and viewing
tables; each micro-batch yields the set of days that received new files.
A click's day comes from its hit time and may lie one day beside its
partition, so the touched days and their neighbours are recomputed from the
full tables, listed anew for every batch (every window is per account-day, so
a day depends on nothing else; contiguous days are computed as one range),
and replaced in the store by one commit, which also drops recomputed days
without rows.
The stream's checkpoint records which files were processed, and rewriting
a day is idempotent, so a restarted or repeated run converges to the same
store.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from watchpath.plans.attribution import attributed_timeline
from watchpath.sources.store import save_attributed
from watchpath.sources.tables import LakeTables


def _days(spark: SparkSession, path: str, date_col: str) -> DataFrame:
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).parquet(path).select(F.col(date_col).alias("day"))


def _runs(days):
    """Contiguous (first, last) day ranges covering the sorted ``days``."""
    runs, lo, prev = [], days[0], days[0]
    for d in days[1:]:
        if (d - prev).days > 1:
            runs.append((lo, prev))
            lo = d
        prev = d
    runs.append((lo, prev))
    return runs


def refresh_attributed(spark: SparkSession, tables: LakeTables, store_path: str,
                       checkpoint_location: str, target: str, brand: str,
                       scope: str = "feeder", click_feeder_mode: str = "lag",
                       available_now: bool = True):
    """Start the refresh query; returns the ``StreamingQuery``.

    ``available_now=True`` processes every file present and stops (a
    scheduled catch-up run); False keeps watching.
    """
    if tables.source != "parquet":
        raise ValueError("the refresh watches Parquet folders; give LakeTables paths")
    changed = (_days(spark, tables.clickstream_path, tables.click_date_col)
               .unionByName(_days(spark, tables.video_path, tables.video_date_col)))

    def refresh(batch: DataFrame, epoch_id: int) -> None:
        # one row per touched day: a handful of dates, not data
        touched = {r.day for r in batch.distinct().collect() if r.day is not None}
        if not touched:
            return
        days = sorted({d + dt.timedelta(days=n) for d in touched for n in (-1, 0, 1)})
        now = replace(tables)                  # lists the files again
        parts = [attributed_timeline(now, lo, hi, target, brand, scope=scope,
                                     click_feeder_mode=click_feeder_mode)
                 for lo, hi in _runs(days)]
        save_attributed(reduce(DataFrame.unionByName, parts), store_path, days)

    writer = (changed.writeStream.foreachBatch(refresh)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="10 minutes")
    return writer.start()
