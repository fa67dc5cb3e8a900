"""Play side of the timeline."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchpath import columns as C
from watchpath.functions.labels import MANUAL, PLAY_END, PLAY_SHIFT_SECONDS
from watchpath.operators.carry import carried_lags, deal, together


def play_events(video: DataFrame, start: dt.date, end: dt.date,
                shift_seconds: int = PLAY_SHIFT_SECONDS) -> DataFrame:
    """Viewings as timeline rows with their feeder (``play_rows`` + ``play_feeder``)."""
    return play_feeder(play_rows(video, start, end, shift_seconds))


def play_rows(video: DataFrame, start: dt.date, end: dt.date,
              shift_seconds: int = PLAY_SHIFT_SECONDS) -> DataFrame:
    """Viewings in [start, end] as timeline rows, feeder columns not yet set.

    Keeps real plays (not a preload, some seconds played). The row is placed
    ``shift_seconds`` earlier so it sorts after the click that started it;
    the day is not changed by the shift.
    """
    v = video.where(
        F.col("adobe_tracking_id").isNotNull()
        & F.col("adobe_date").between(F.lit(start), F.lit(end))
        & (F.col("media_load") == F.lit(False))
        & (F.col("num_seconds_played_with_ads") > 0)
    )
    rows = v.select(
        F.col("adobe_tracking_id").alias(C.ACCOUNT),
        F.col("adobe_date").alias(C.DAY),
        (F.col("adobe_timestamp") - F.make_dt_interval(secs=F.lit(shift_seconds))).alias(C.TIME),
        F.lit("").alias(C.PLAYER_EVENT),
        F.lit("").alias(C.DETAILS),
        F.when(F.col("display_name").like("%trailer%"), F.lit(MANUAL))
        .otherwise(F.lit(PLAY_END)).alias(C.START_TYPE),
        F.col("device_name").alias(C.DEVICE),
        F.col("display_name").alias(C.TITLE),
        F.col("video_id").alias(C.VIDEO_ID),
        F.col("num_seconds_played_no_ads").alias(C.SECONDS),
    )
    return rows


def play_feeder(rows: DataFrame, tiebreak=(), parts: int | None = None) -> DataFrame:
    """Feeder title and feeder video id: the previous viewing's, same account-day.

    The LAG runs on range partitions (``operators.carry``), so an account-day of any size is spread.
    """
    keys = [C.ACCOUNT, C.DAY]
    dealt = deal(rows, keys, [C.TIME], tiebreak, parts, "plays")
    lagged = carried_lags(together(dealt, keys), keys, [C.TIME], [(C.FEEDER, C.TITLE), (C.FEEDER_ID, C.VIDEO_ID)],
                          tiebreak=tiebreak)
    return lagged.select(*C.TIMELINE)
