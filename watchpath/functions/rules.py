"""Final start type and credited watch time of a timeline row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from watchpath import columns as C
from watchpath.functions.labels import (
    AUTO_PLAY,
    MANUAL,
    PLAY_END,
    SHORT_VIEW_SECONDS,
    UNATTRIBUTED,
    UP_NEXT,
)
from watchpath.functions.memo import memo_column


@memo_column
def attributed_start_type(short_view_seconds: int = SHORT_VIEW_SECONDS) -> Column:
    """Ten ordered rules, first match wins (three-valued logic as in SQL).

    A blank feeder ('') and a NULL feeder differ on purpose: '' <> title is
    true, NULL <> title is unknown.
    """
    feeder, title = F.col(C.FEEDER), F.col(C.TITLE)
    secs, ep = F.col(C.SECONDS), F.col(C.EPISODE_TIME)
    prev, kind = F.col(C.LAST_ACTION), F.col(C.START_TYPE)
    moved_on = feeder != title
    return (
        F.when(feeder.isNull() & secs.isNotNull(), MANUAL)
        .when(F.lower(feeder).like("%trailer%"), MANUAL)
        .when(prev.like("%Manual%") & (kind == PLAY_END), MANUAL)
        .when((prev == AUTO_PLAY) & (kind == PLAY_END) & ~feeder.like("%trailer%"), AUTO_PLAY)
        .when((prev == UP_NEXT) & (kind == PLAY_END) & ~feeder.like("%trailer%"), UP_NEXT)
        .when(moved_on & (ep > 0) & secs.isNotNull(), AUTO_PLAY)
        .when(moved_on & (feeder != "") & (ep == 0) & (secs <= short_view_seconds), AUTO_PLAY)
        .when(moved_on & (feeder != "") & (ep == 0) & (secs > short_view_seconds), UNATTRIBUTED)
        .when((kind == AUTO_PLAY) & (feeder.isNull() | (feeder == "")), MANUAL)
        .otherwise(kind)
    )


@memo_column
def new_watch_time() -> Column:
    """Head of a run: own seconds plus the run's continuation seconds; else 0."""
    feeder, title = F.col(C.FEEDER), F.col(C.TITLE)
    return (
        F.when(feeder.isNull() | (feeder != title),
               F.coalesce(F.col(C.SECONDS), F.lit(0)) + F.col(C.EPISODE_TIME))
        .otherwise(F.lit(0).cast("bigint"))
    )
