"""Top feeder series per day, and the device-scoped feed list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchpath import columns as C
from watchpath.functions.dates import as_date
from watchpath.functions.labels import EASTERN, TOP_K
from watchpath.operators.clicks import click_feeder, classify_clicks, normalize_clicks
from watchpath.operators.order import published_order
from watchpath.operators.feeders import (
    COMBINATION,
    conditional_reach,
    episode_series_counts,
    episode_series_map,
    exclude_channels,
    feeder_to_series,
    linear_channels,
    series_cue_only,
    top_feeders,
)
from watchpath.sources.tables import Tables


def feeder_clicks(tables: Tables, start, end, brand: str, tz: str = EASTERN,
                  device_like: str | None = None) -> DataFrame:
    """Classified clicks with the LAG feeder (device scope before the LAG)."""
    start, end = as_date(start), as_date(end)
    clicks = normalize_clicks(tables.clickstream(start, end), start, end, tz,
                              with_device=device_like is not None)
    clicks = classify_clicks(clicks, brand, device_like=device_like)
    return click_feeder(clicks, "lag").select(*C.TIMELINE)


def series_map(tables: Tables, start, end, per_day: bool = True) -> DataFrame:
    start, end = as_date(start), as_date(end)
    return episode_series_map(episode_series_counts(tables.video(start, end), start, end), per_day)


def feeder_reach(tables: Tables, start, end, brand: str, tz: str = EASTERN,
                 with_title: bool = False, device_like: str | None = None,
                 map_day=None, channel_day=None) -> DataFrame:
    """Per day and feeder series (and destination title when ``with_title``):
    distinct accounts moved on by auto-play / up-next / either.

    Each day has its own map and channels; ``map_day`` and ``channel_day`` name one day
    whose map (channels) holds for all click days, inside [start, end] or not.
    """
    start, end = as_date(start), as_date(end)
    if map_day is None:
        mapping = series_map(tables, start, end)
    else:
        mapping = series_map(tables, map_day, map_day, per_day=False)
    first, last = (start, end) if channel_day is None else (as_date(channel_day),) * 2
    channels = linear_channels(tables.video(first, last), first, last, per_day=channel_day is None)
    combos = feeder_to_series(feeder_clicks(tables, start, end, brand, tz, device_like), mapping)
    combos = exclude_channels(series_cue_only(combos), channels)
    keys = (C.DAY, COMBINATION, C.TITLE) if with_title else (C.DAY, COMBINATION)
    return conditional_reach(combos, keys)


def top_feeders_daily(tables: Tables, start, end, brand: str, k: int = TOP_K,
                      tz: str = EASTERN, ordered: bool = False) -> DataFrame:
    """Daily top-``k`` feeder series by distinct accounts moved on."""
    return published_order(top_feeders(feeder_reach(tables, start, end, brand, tz), k),
                           "top_feeders", ordered)


def feeder_destination_pairs(tables: Tables, start, end, brand: str, tz: str = EASTERN,
                             series: str | None = None, device_like: str | None = None,
                             map_day=None, channel_day=None) -> DataFrame:
    """Reach per (day, feeder series, destination title); optional one-series filter."""
    r = feeder_reach(tables, start, end, brand, tz, True, device_like, map_day, channel_day)
    if series is not None:
        r = r.where(F.col(COMBINATION) == series)
    return r.select(C.DAY, F.col(COMBINATION).alias("Auto_Binge_Source_Titles"), C.TITLE,
                    "Unique_Auto_Binge_Accounts", "Unique_Click_Next_Accounts",
                    "Total_Unique_Accounts")


def device_feed_list(tables: Tables, start, end, map_start, map_end, device_like: str,
                     brand: str, tz: str = EASTERN, ordered: bool = False) -> DataFrame:
    """Row-level series->series feed list for one device family.

    Clicks come from [start, end]; the episode->series map is built from the
    viewings of [map_start, map_end] (a separate window, summed over it).
    """
    clicks = feeder_clicks(tables, start, end, brand, tz, device_like=device_like)
    mapping = series_map(tables, map_start, map_end, per_day=False)
    rows = series_cue_only(feeder_to_series(clicks, mapping)).select(*C.TIMELINE, COMBINATION)
    return published_order(rows, "feed_list", ordered)


def device_top_feeders(tables: Tables, start, end, device_like: str, brand: str,
                       k: int = TOP_K, tz: str = EASTERN, map_day=None, channel_day=None) -> DataFrame:
    """The daily ranking over one device family's clicks (see ``feeder_reach`` for the days)."""
    return top_feeders(feeder_reach(tables, start, end, brand, tz, False, device_like, map_day, channel_day), k)
