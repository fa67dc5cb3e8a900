"""Merged timeline: scope, union, previous action, runs, attribution.

All windows here are keyed by (account, day) and run on range partitions of it
(``operators.carry``), so an account-day of any size is spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchpath import columns as C
from watchpath.functions.rules import attributed_start_type, new_watch_time
from watchpath.operators.carry import DEALT, PART, carried_lags, carried_runs, deal, together

KEYS = [C.ACCOUNT, C.DAY]
#: Kind of a row of the joint timeline: False a click, True a play.
IS_PLAY = "_play"


def scope_by_title(df: DataFrame, target: str) -> DataFrame:
    """Rows whose own title equals ``target`` in any case."""
    return df.where(F.lower(C.TITLE) == F.lower(F.lit(target)))


def scope_by_feeder(df: DataFrame, target: str) -> DataFrame:
    """Rows whose feeder equals ``target`` in any case (apply after the LAGs)."""
    return df.where(F.lower(C.FEEDER) == F.lower(F.lit(target)))


def merge_timeline(clicks: DataFrame, plays: DataFrame) -> DataFrame:
    """Clicks and plays in one timeline; duplicates are kept (UNION ALL)."""
    return clicks.select(*C.TIMELINE).unionByName(plays.select(*C.TIMELINE))


def dealt_timeline(clicks: DataFrame, plays: DataFrame, tiebreak=(), parts: int | None = None) -> DataFrame:
    """Clicks and plays, feeders not yet set, dealt over range partitions of (account, day, time)."""
    columns = [c for c in C.TIMELINE if c not in (C.FEEDER, C.FEEDER_ID)]
    both = (clicks.select(*columns, F.lit(False).alias(IS_PLAY))
            .unionByName(plays.select(*columns, F.lit(True).alias(IS_PLAY))))
    return deal(both, KEYS, [C.TIME], tiebreak, parts, "timeline")


def with_feeders(dealt: DataFrame, click_feeder_mode: str = "lag", tiebreak=()) -> DataFrame:
    """Feeders of a dealt timeline, of clicks and of plays each among their own kind, in one window pass."""
    if click_feeder_mode not in ("lag", "blank"):
        raise ValueError(f"unknown click feeder mode {click_feeder_mode!r}")
    lagged = carried_lags(together(dealt, KEYS), KEYS, [C.TIME], [("_title", C.TITLE), ("_id", C.VIDEO_ID)],
                          by=[IS_PLAY], tiebreak=tiebreak)
    is_play, blank = F.col(IS_PLAY), F.lit("")
    feeder = F.col("_title") if click_feeder_mode == "lag" else F.when(is_play, F.col("_title")).otherwise(blank)
    return (lagged.withColumn(C.FEEDER, feeder)
            .withColumn(C.FEEDER_ID, F.when(is_play, F.col("_id")).otherwise(blank)).drop("_title", "_id"))


def continues_run():
    """A row continues its run when its feeder is its own title (exact case)."""
    return F.col(C.FEEDER) == F.col(C.TITLE)


def sessionize(timeline: DataFrame, tiebreak=(), parts: int | None = None, dealt: DataFrame | None = None) -> DataFrame:
    """Previous action, run id and the run's continuation seconds.

    The run id counts the rows that are not continuations, over a RANGE
    frame ordered by time, so rows at the same instant share a run.
    ``Episode_Time`` is the sum of the continuation seconds of the run,
    repeated on each of its rows (NULL when the run has only clicks that
    continue it). ``dealt``: the dealt table that ``timeline`` is a part of, where there is one.
    """
    cont = continues_run()
    rows = deal(timeline, KEYS, [C.TIME], tiebreak, parts, "timeline")
    found = carried_runs(rows, KEYS, [C.TIME], F.when(cont, F.lit(0)).otherwise(F.lit(1)),
                         F.when(cont, F.col(C.SECONDS)).otherwise(F.lit(0)), C.RUN, C.EPISODE_TIME,
                         dealt=dealt if PART in timeline.columns else None,
                         lags=[(C.LAST_ACTION, C.START_TYPE)], tiebreak=tiebreak)
    return found.select(*[c for c in timeline.columns if c not in (*DEALT, IS_PLAY)], C.LAST_ACTION, C.RUN, C.EPISODE_TIME)


def attribute(sessions: DataFrame) -> DataFrame:
    """Final start type and credited watch time, in the published column order."""
    return sessions.select(
        C.ACCOUNT, C.DAY, C.TIME, C.LAST_ACTION,
        attributed_start_type().alias(C.START_TYPE),
        C.DEVICE, C.FEEDER, C.FEEDER_ID, C.TITLE, C.VIDEO_ID, C.SECONDS,
        new_watch_time().alias(C.WATCH_TIME),
    )
