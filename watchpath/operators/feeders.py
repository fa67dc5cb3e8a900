"""Feeder series: episode->series map, feeder combinations, daily reach and rank.

Everything is keyed by day, so a date range is the daily report run for
each of its days (each day with its own map and channel list).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from watchpath import columns as C
from watchpath.functions.labels import (
    AUTO_PLAY,
    EXCLUDED_EPISODES,
    NO_CHANNEL,
    NO_EPISODE,
    NO_SERIES,
    TOP_K,
    UP_NEXT,
    VIEW_ALL,
)
from watchpath.functions.titles import clean_title, series_or_null
from watchpath.operators.joins import join_small

COMBINATION = "Combination"


def episode_series_counts(video: DataFrame, start: dt.date, end: dt.date,
                          excluded_episodes=EXCLUDED_EPISODES) -> DataFrame:
    """Viewings per (day, cleaned episode, cleaned series); station names give
    a NULL series; listed bad episode titles are dropped."""
    v = video.where(
        F.col("episode_title").isNotNull()
        & ~F.lower("episode_title").isin(*excluded_episodes)
        & F.col("adobe_date").between(F.lit(start), F.lit(end))
    )
    return (v.groupBy(F.col("adobe_date").alias(C.DAY),
                      clean_title("episode_title").alias("Episode"),
                      series_or_null("display_name").alias("Series"))
            .agg(F.count("display_name").alias("Display_Time")))


def episode_series_map(counts: DataFrame, per_day: bool = True) -> DataFrame:
    """Most-viewed series of each episode; ties keep every tied series.

    ``per_day=False`` sums the counts over all days first (one map for the
    whole range).
    """
    if not per_day:
        counts = (counts.groupBy("Episode", "Series")
                  .agg(F.sum("Display_Time").alias("Display_Time")))
    keys = [C.DAY, "Episode"] if per_day else ["Episode"]
    c = counts.where(
        F.col("Series").isNotNull() & (F.col("Series") != NO_SERIES)
        & F.col("Episode").isNotNull() & (F.col("Episode") != NO_EPISODE)
    )
    w = Window.partitionBy(*keys).orderBy(F.desc("Display_Time"))
    # rank filter = 1 is planned as a WindowGroupLimit on both sides of the shuffle
    return (c.withColumn("_rk", F.dense_rank().over(w)).where(F.col("_rk") == 1)
            .select(*keys, "Series"))


def feeder_to_series(clicks: DataFrame, mapping: DataFrame) -> DataFrame:
    """``Combination``: the feeder's series when the map knows the feeder as an
    episode, else the cleaned feeder. A tied map duplicates the click.

    Clicks without a feeder (a third or more of them) match nothing. They get a key of
    their own each, as NULL keys would all meet in one task where the map is too large to broadcast.
    """
    per_day = C.DAY in mapping.columns
    keys = [C.DAY, "Episode"] if per_day else ["Episode"]
    alone = F.concat(F.lit("\0"), C.ACCOUNT, F.col(C.TIME).cast("string"))
    left = clicks.withColumn("_known", clean_title(C.FEEDER)).withColumn("Episode", F.coalesce("_known", alone))
    return (join_small(left, mapping, keys, "left")
            .withColumn(COMBINATION, F.coalesce("Series", "_known")).select(*clicks.columns, COMBINATION))


def series_cue_only(df: DataFrame) -> DataFrame:
    """Series-to-series cue-up signals (apply after the feeder LAG)."""
    return df.where(F.lower(C.DETAILS).like("%series%cue%up%"))


def linear_channels(video: DataFrame, start: dt.date, end: dt.date, per_day: bool = True) -> DataFrame:
    """Distinct cleaned linear channel names per day (``per_day=False``: of all days together)."""
    names = video.where(F.col("adobe_date").between(F.lit(start), F.lit(end))
                        & (F.col("content_channel") != NO_CHANNEL))
    day = [F.col("adobe_date").alias(C.DAY)] if per_day else []
    return names.select(*day, clean_title("content_channel").alias(COMBINATION)).distinct()


def exclude_channels(df: DataFrame, channels: DataFrame) -> DataFrame:
    """Drop NULL, 'view-all' and linear-channel combinations.

    Neither side can hold a NULL key here, so NOT IN is a plain anti join.
    """
    kept = df.where(F.col(COMBINATION).isNotNull() & (F.col(COMBINATION) != VIEW_ALL))
    keys = [C.DAY, COMBINATION] if C.DAY in channels.columns else [COMBINATION]
    return join_small(kept, channels, keys, "left_anti")


def conditional_reach(df: DataFrame, keys=(C.DAY, COMBINATION)) -> DataFrame:
    """Distinct accounts moved on by auto-play, by up-next, and by either.

    Pre-aggregated to one row per (keys, account) with two flags, then
    summed: no Expand of three distinct aggregates, and partial aggregation
    keeps a hot key cheap.
    """
    keys = list(keys)
    kind = F.col(C.START_TYPE)
    per_account = (df.groupBy(*keys, C.ACCOUNT)
                   .agg(F.max((kind == AUTO_PLAY).cast("int")).alias("_a"),
                        F.max((kind == UP_NEXT).cast("int")).alias("_n")))
    return (per_account.groupBy(*keys)
            .agg(F.count(F.when(F.col("_a") == 1, True)).alias("Unique_Auto_Binge_Accounts"),
                 F.count(F.when(F.col("_n") == 1, True)).alias("Unique_Click_Next_Accounts"),
                 F.count(F.when((F.col("_a") == 1) | (F.col("_n") == 1), True))
                 .alias("Total_Unique_Accounts")))


def top_feeders(reach: DataFrame, k: int = TOP_K) -> DataFrame:
    """Dense rank per day by total reach, ranks up to ``k`` (ties kept)."""
    w = Window.partitionBy(C.DAY).orderBy(F.desc("Total_Unique_Accounts"))
    return (reach.withColumn("Daily_Ranks", F.dense_rank().over(w))
            .where(F.col("Daily_Ranks") <= k)
            .select(C.DAY, "Daily_Ranks", F.col(COMBINATION).alias("Auto_Binge_Source_Titles"),
                    "Unique_Auto_Binge_Accounts", "Unique_Click_Next_Accounts",
                    "Total_Unique_Accounts"))
