"""Stand-in source tables derived from the generic ``events`` table.

The real inputs (a player clickstream and a viewing mart) are not available
here, so both are derived row by row from ``events`` with fixed rules, the
same rules the SQL oracle spells out independently. Each events row becomes
exactly one clickstream row (types click/signup/error) or one viewing row
(types view/purchase); nothing is sampled or capped, so the tables grow with
``events``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from watchpath.functions.labels import EASTERN
from watchpath.sources.tables import Tables

# --- fixed values of the stand-in format ----------------------------------
PLAYER_EVENT_BRAND = "player"
TITLES = (
    "alpha show", "Bravo: Live!", "charlie trailer", "Alpha Show", "view-all",
    "alpha show", "Delta", "Echo & Co.", "Alpha Show", "Foxtrot",
)
CLICK_TYPES = ("click", "signup", "error")
VIEW_TYPES = ("view", "purchase")
PLATFORMS = ("Xfinity", "xfinity", "Android TV", "Xbox One", "PS4", "Roku", "Fire TV", "Fire TV")
DEVICE_CODES = ("x:1001", "x:2002", None)
SHOWS = ("Bravo: Live!", "charlie", "Charlie Trailer", "other")
CLICK_PATHS = ("cue|Alpha Show|auto-play", "cue|alpha show|click",
               "cue|alpha show trailer|click", "cue|alpha show|view", "cue|alpha show|view")
STATIONS = ("WXYZ-DT", "KAB1-X", "ABC", "Local TV")
EPISODES = ("alpha show", "Charlie Trailer", "Pilot")
CHANNELS = ("Bravo Live", "N/A", "N/A", None, None, None)
PROGRAMS = ("alpha show", "Alpha: Show", "Bravo: Live!", "Alpha Show: Recap", "Alpha Show & Friends")
LOOKUPS = ("Alpha: Show", "Alpha Show: Recap", "Bravo: Live!", "Alpha Show & Friends")
#: What an account of the share that never watched the target watches in its place.
INSTEAD = "Delta"


def _pick(values, index: Column) -> Column:
    """values[index] for a 0-based integer column."""
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (index + 1).cast("int"))


def _idiv(c: Column, n: int) -> Column:
    return (c / n).cast("bigint")          # non-negative ids: truncation = floor


def _shared(events: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("int")
    local = F.convert_timezone(F.lit("UTC"), F.lit(EASTERN), F.col("ts"))
    account = F.when(eid % 97 == 0, F.lit(None).cast("string")).otherwise(
        _idiv(F.col("user_id"), 8).cast("string"))
    return events.select(
        "*",
        k.alias("_k"),
        (_idiv(eid, 7) % 6).alias("_v"),
        local.alias("_et"),
        _pick(TITLES, _idiv(k, 10)).alias("_t"),
        account.alias("_account"),
    )


@dataclass
class StandInTables(Tables):
    """``clickstream`` and ``video`` over ``<sf_dir>/events.parquet``."""

    spark: SparkSession
    sf_dir: str

    def events(self, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
        ev = self.spark.read.parquet(f"{self.sf_dir}/events.parquet")
        # GMT bounds padded by a day: a superset of the Eastern dates asked for;
        # these reach the Parquet reader as pushed filters on ``ts``
        if start is not None:
            ev = ev.where(F.col("ts") >= F.lit(f"{start - dt.timedelta(days=1)} 00:00:00").cast("timestamp_ntz"))
        if end is not None:
            ev = ev.where(F.col("ts") < F.lit(f"{end + dt.timedelta(days=2)} 00:00:00").cast("timestamp_ntz"))
        return ev

    def clickstream(self, start=None, end=None) -> DataFrame:
        ev = _shared(self.events(start, end).where(F.col("event_type").isin(*CLICK_TYPES)))
        eid, k10, t = F.col("event_id"), F.col("_k") % 10, F.col("_t")
        v = F.col("_v")
        cue = F.concat(F.lit("series:cue-up||"), t)
        details = (
            F.when(k10 <= 1, F.concat(cue, F.lit("|auto-play")))
            .when(k10 == 2, F.concat(cue, F.lit("|click")))
            .when(k10 == 3, F.concat(cue, F.lit("|dismiss")))
            .when(k10 == 4, F.concat(F.lit("deeplink|"), t))
            .when(k10 == 5, F.concat(F.lit("rail|"), t, F.lit("|click")))
            .when(k10 <= 7, F.lit("browse"))
            .when(k10 == 8, F.concat(F.lit("rail|"), t, F.lit("|display")))
        )
        page = f"{PLAYER_EVENT_BRAND}:details:"
        player = (
            F.when(k10 == 6, F.concat(F.lit(page + "episodes:"), t))
            .when(k10 == 7, F.concat(F.lit(page + "more-like-this:"), t))
            .when((k10 == 1) & (eid % 5 == 0), F.concat(F.lit(page), t))
            .when((k10 == 5) & (eid % 4 == 0), F.concat(F.lit(page + "upsell:"), t))
            .when((k10 == 5) & (eid % 4 == 1), F.concat(F.lit(page + "extras:"), t))
            .otherwise(F.lit(f"{PLAYER_EVENT_BRAND}:home"))
        )
        binge_from = (
            F.when(eid % 3 != 1, _pick(LOOKUPS, v % 4))
            .when(eid % 11 == 0, F.lit(None).cast("string"))
            .otherwise(F.lit("Bravo: Live!"))
        )
        cue_up = (
            F.when((eid % 2 == 0) & (_idiv(eid, 24) % 2 == 0), F.concat(F.lit("s|a|b|c|v"), v.cast("string")))
            .when(eid % 2 == 0, F.concat(F.lit("m|a|b|c|v"), v.cast("string")))
            .when(eid % 9 == 0, F.lit("s|a"))
        )
        return ev.select(
            F.col("_account").alias("post_evar56"),
            F.col("ts").alias("post_cust_hit_time_gmt"),
            details.alias("post_evar7"),
            player.alias("post_evar19"),
            _pick(PLATFORMS, eid % 8).alias("post_evar37"),
            _pick(DEVICE_CODES, eid % 3).alias("post_evar53"),
            F.when(eid % 2 == 0, F.lit("chromecast")).alias("post_evar106"),
            _pick(SHOWS, _idiv(eid, 3) % 4).alias("post_evar28"),
            F.concat(F.lit("v"), v.cast("string")).alias("post_prop21"),
            binge_from.alias("post_evar72"),
            cue_up.alias("post_prop47"),
            _pick(CLICK_PATHS, eid % 5).alias("post_prop15"),
            F.lit(None).cast("string").alias("post_evar59"),
            F.col("ts").alias("RevisedTimeStamp"),
            F.to_date("_et").alias("adobe_date_est"),
        )

    def video(self, start=None, end=None) -> DataFrame:
        ev = _shared(self.events(start, end).where(F.col("event_type").isin(*VIEW_TYPES)))
        eid, value = F.col("event_id"), F.col("value")
        new_to_target = (_idiv(F.col("user_id"), 8) % 3 == 0) & (F.lower("_t") == "alpha show")
        display = (F.when(eid % 13 == 0, _pick(STATIONS, eid % 4))
                   .when(new_to_target, F.lit(INSTEAD)).otherwise(F.col("_t")))
        episode = (
            F.when(eid % 17 == 0, F.lit(None).cast("string"))
            .when(eid % 23 == 0, F.lit("Yellowstone"))
            .otherwise(_pick(EPISODES, F.col("_k") % 3))
        )
        return ev.select(
            F.col("_account").alias("adobe_tracking_id"),
            F.to_date("_et").alias("adobe_date"),
            F.col("_et").alias("adobe_timestamp"),
            F.when(eid % 3 == 0, F.lit("Fire TV")).otherwise(F.lit("Roku")).alias("device_name"),
            display.alias("display_name"),
            F.concat(F.lit("v"), F.col("_v").cast("string")).alias("video_id"),
            F.when(eid % 3 == 0, F.floor(value * 60)).otherwise(F.floor(value))
            .cast("bigint").alias("num_seconds_played_no_ads"),
            (F.floor(value) + 15 * (eid % 2)).cast("bigint").alias("num_seconds_played_with_ads"),
            (eid % 19 == 0).alias("media_load"),
            (eid % 2).cast("bigint").alias("num_views_started"),
            episode.alias("episode_title"),
            _pick(CHANNELS, eid % 6).alias("content_channel"),
            _pick(PROGRAMS, _idiv(eid, 5) % 5).alias("program"),
        )


def materialized(spark: SparkSession, sf_dir: str) -> Tables:
    """The stand-in written once as date-partitioned Parquet, read as lake tables.

    This is the layout of the real sources (clickstream partitioned by its
    Eastern date, the viewing mart by ``adobe_date``), so queries over it get
    partition pruning and plain column scans. The files go to a folder under
    the session's checkpoint directory (shared storage on a cluster) and are
    reused by every later query of the session for the same events file.
    """
    import hashlib
    import os

    from watchpath.session import checkpoint_dir
    from watchpath.sources.tables import LakeTables

    src = f"{sf_dir}/events.parquet"
    try:
        st = os.stat(src)
        stamp = f"{os.path.abspath(src)}:{st.st_size}:{st.st_mtime_ns}"
    except OSError:
        stamp = src
    key = hashlib.sha1(stamp.encode()).hexdigest()[:16]
    root = f"{checkpoint_dir(spark).rstrip('/')}/standin-{key}"
    if root not in _WRITTEN:
        lazy = StandInTables(spark, sf_dir)
        for name, df, part in (("clickstream", lazy.clickstream(), "adobe_date_est"),
                               ("video", lazy.video(), "adobe_date")):
            # rebalanced by day: small days share a task, large ones are split
            (df.hint("rebalance", F.col(part)).write.mode("overwrite")
               .partitionBy(part).parquet(f"{root}/{name}"))
        _WRITTEN.add(root)
    cached = _TABLES.get(root)
    if cached is None or cached.spark is not spark:     # files are shared by sessions
        cached = _TABLES[root] = LakeTables(spark, f"{root}/clickstream", f"{root}/video")
    return cached


_WRITTEN: set[str] = set()
_TABLES: dict[str, Tables] = {}
