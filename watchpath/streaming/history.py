"""The promo report's viewing history, kept per account and merged as files land.

The report asks whether an account watched the target before, since a start date
long ago: read anew, that history grows with every day. Here a Structured
Streaming file source reads each viewing file once and merges it into a state of a
row per account (``operators.promo.viewer_history``), so a daily run reads the new
days only. The merge takes least and greatest values, so late files of older days, files
in any order and a batch that is run twice give the same state as a full recompute.

The state is a folder of versions, one per micro-batch. A version is written beside the
others and counts once it is complete (Spark's ``_SUCCESS`` file), so a run that
dies leaves the last version in force. The version before is kept for readers that
have begun; older ones are removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from watchpath.operators.promo import merge_history, viewer_history
from watchpath.sources.tables import LakeTables

_VERSION = "version="


def _folder(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions, rising."""
    fs, where = _folder(spark, path)
    if not fs.exists(where):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(where)]
    numbers = [int(n.removeprefix(_VERSION)) for n in names if n.startswith(_VERSION)]
    done = _folder(spark, path)[0]
    jvm = spark.sparkContext._jvm
    return sorted(n for n in numbers if done.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{_VERSION}{n}/_SUCCESS")))


def load_history(spark: SparkSession, path: str) -> DataFrame | None:
    """The state in force; None before the first run."""
    found = versions(spark, path)
    return spark.read.parquet(f"{path}/{_VERSION}{found[-1]}") if found else None


def _write(state: DataFrame, path: str, number: int) -> None:
    spark = state.sparkSession
    state.write.mode("overwrite").parquet(f"{path}/{_VERSION}{number}")
    for old in versions(spark, path)[:-2]:
        fs, where = _folder(spark, f"{path}/{_VERSION}{old}")
        fs.delete(where, True)


def merge_viewings(spark: SparkSession, path: str, video: DataFrame, titles, target: str) -> None:
    """Merges viewings (new or late ones, or some again) into the state under ``path``."""
    new = viewer_history(video, titles, target)
    found = versions(spark, path)
    old = load_history(spark, path)
    _write(new if old is None else merge_history(old, new), path, found[-1] + 1 if found else 0)


def refresh_history(spark: SparkSession, tables: LakeTables, state_path: str, checkpoint_location: str,
                    titles, target: str, available_now: bool = True):
    """Starts the merge of every viewing file not read so far; returns the ``StreamingQuery``.

    ``available_now=True`` reads the files present and stops (a scheduled run); False keeps watching.
    """
    if tables.source != "parquet":
        raise ValueError("the refresh watches Parquet folders; give LakeTables paths")
    schema = spark.read.parquet(tables.video_path).schema
    files = spark.readStream.schema(schema).parquet(tables.video_path).withColumnRenamed(tables.video_date_col, "adobe_date")
    needed = files.select("adobe_tracking_id", "adobe_date", "adobe_timestamp", "display_name", "num_views_started",
                          "num_seconds_played_no_ads")

    def merge(batch: DataFrame, epoch: int) -> None:
        merge_viewings(spark, state_path, batch, titles, target)

    writer = needed.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint_location)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 minutes")).start()
