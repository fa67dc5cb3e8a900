"""Reports over the attributed timeline: day totals and auto-play share."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from watchpath import columns as C
from watchpath.functions.hours import hour_hundredths
from watchpath.functions.labels import AUTO_PLAY, MINOR_FEEDER_SHARE, UNATTRIBUTED
from watchpath.operators.order import published_order
from watchpath.session import materialize


def _hours(hundredths: str) -> F.Column:
    return (F.col(hundredths) / F.lit(100)).cast("double")


def daily_hours(attributed: DataFrame) -> DataFrame:
    """Hours credited per day, rounded to 2 decimals."""
    return (attributed.groupBy(C.DAY)
            .agg(hour_hundredths(F.sum(C.WATCH_TIME)).alias("_h"))
            .select(C.DAY, _hours("_h").alias("Total_Watch_Time")))


def _destination_hundredths(attributed: DataFrame, titles) -> DataFrame:
    titles = [t.lower() for t in titles]
    return (attributed
            .where(F.lower(C.TITLE).isin(*titles) & (F.col(C.START_TYPE) == AUTO_PLAY))
            .groupBy(C.DAY, C.FEEDER, C.TITLE)
            .agg(F.countDistinct(C.ACCOUNT).alias("Unique_Accounts"),
                 hour_hundredths(F.sum(C.WATCH_TIME)).alias("_h")))


def autoplay_destinations(attributed: DataFrame, titles) -> DataFrame:
    """Per day, feeder and destination title (one of ``titles``, any case),
    auto-play rows only: distinct accounts and hours (2 decimals)."""
    d = _destination_hundredths(attributed, titles)
    return d.select(C.DAY, C.FEEDER, C.TITLE, "Unique_Accounts",
                    _hours("_h").alias("New_Watch_Times"))


def _variants(attributed: DataFrame, titles) -> tuple[DataFrame, DataFrame]:
    """Auto-play metrics per (day, feeder, title) as spelled, written once, and the hours of each day."""
    titles = [t.lower() for t in titles]
    dest = F.lower(C.TITLE).isin(*titles) & (F.col(C.START_TYPE) == AUTO_PLAY)
    groups = (attributed.groupBy(C.DAY, C.FEEDER, C.TITLE)
              .agg(F.sum(C.WATCH_TIME).alias("_all"),
                   F.max(dest.cast("int")).alias("_is_dest"),
                   F.countDistinct(F.when(dest, F.col(C.ACCOUNT))).alias("Unique_Accounts"),
                   F.sum(F.when(dest, F.col(C.WATCH_TIME))).alias("_dest_s")))
    groups = materialize(groups, "share-groups")
    totals = (groups.groupBy(C.DAY).agg(hour_hundredths(F.sum("_all")).alias("_t"))
              .select(C.DAY, _hours("_t").alias("Total_Watch_Time")))
    return groups, totals


def autoplay_share(attributed: DataFrame, titles, ordered: bool = False) -> DataFrame:
    """Destinations with titles case-folded, re-summed, and their share of the day.

    Accounts are summed across case variants (an account seen under two
    spellings counts twice, as published). Hours are sums of the rounded
    per-variant hours, added exactly in hundredths. The attributed rows are
    aggregated once per (day, feeder, title), carrying both the all-rows sum
    (for the day totals) and the auto-play destination metrics; that small
    table is written once, so the timeline is computed once for both uses.
    The day totals have one row per day and are broadcast. A zero day total
    gives a NULL share.
    """
    groups, totals = _variants(attributed, titles)
    folded = (groups.where(F.col("_is_dest") == 1)
              .withColumn("_h", hour_hundredths(F.col("_dest_s")))
              .groupBy(C.DAY, F.lower(C.FEEDER).alias(C.FEEDER), F.lower(C.TITLE).alias(C.TITLE))
              .agg(F.sum("Unique_Accounts").alias("Unique_Accounts"), F.sum("_h").alias("_h"))
              .select(C.DAY, C.FEEDER, C.TITLE, "Unique_Accounts", _hours("_h").alias("New_Watch_Times")))
    share = (folded.join(F.broadcast(totals), C.DAY, "left")
             .select(C.DAY, C.FEEDER, C.TITLE, "Unique_Accounts", "New_Watch_Times",
                     "Total_Watch_Time",
                     F.try_divide(F.col("New_Watch_Times"), F.col("Total_Watch_Time"))
                     .alias("Prc_of_Total")))
    return published_order(share, "share", ordered)


def fold_minor_feeders(attributed: DataFrame, titles, min_share: float = MINOR_FEEDER_SHARE) -> DataFrame:
    """The share report with minor feeders folded: a feeder, as spelled, at or below ``min_share`` of the
    day's hours for a destination becomes Unattributed.

    The test comes before destinations are case-folded and summed, so two spellings at 0.3 % each
    are both folded; feeders above it keep their spelling.
    """
    groups, totals = _variants(attributed, titles)
    tested = (groups.where(F.col("_is_dest") == 1).withColumn("_h", hour_hundredths(F.col("_dest_s")))
              .join(F.broadcast(totals), C.DAY, "left"))                # one row per day
    part = F.try_divide(_hours("_h"), F.col("Total_Watch_Time"))
    feeder = F.when(part > min_share, F.col(C.FEEDER)).otherwise(F.lit(UNATTRIBUTED))
    return (tested.groupBy(C.DAY, feeder.alias(C.FEEDER), F.lower(C.TITLE).alias(C.TITLE))
            .agg(F.sum("Unique_Accounts").alias("Unique_Accounts"), F.sum("_h").alias("_h"),
                 F.first("Total_Watch_Time").alias("Total_Watch_Time"))
            .select(C.DAY, C.FEEDER, C.TITLE, "Unique_Accounts", _hours("_h").alias("New_Watch_Times"),
                    "Total_Watch_Time",
                    F.try_divide(_hours("_h"), F.col("Total_Watch_Time")).alias("Prc_of_Total")))


def daily_start_type_totals(attributed: DataFrame) -> DataFrame:
    """Per day and final start type: distinct accounts and hours, plus the
    day's total hours on each row."""
    g = (attributed.groupBy(C.DAY, C.START_TYPE)
         .agg(F.countDistinct(C.ACCOUNT).alias("Unique_Accounts"),
              hour_hundredths(F.sum(C.WATCH_TIME)).alias("_h")))
    day = Window.partitionBy(C.DAY)
    return g.select(C.DAY, C.START_TYPE, "Unique_Accounts",
                    _hours("_h").alias(C.WATCH_TIME),
                    (F.sum("_h").over(day) / F.lit(100)).cast("double").alias("Watch_Total"))
