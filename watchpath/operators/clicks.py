"""Click side of the timeline: normalise, classify, scope, feeder."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from watchpath import columns as C
from watchpath.functions.devices import device_family
from watchpath.functions.labels import EASTERN
from watchpath.functions.titles import clicked_title, start_type
from watchpath.operators.carry import carried_lags, deal, together


def _ts_literal(d: dt.date):
    return F.lit(f"{d} 00:00:00").cast("timestamp_ntz")


def normalize_clicks(raw: DataFrame, start: dt.date, end: dt.date,
                     tz: str = EASTERN, with_device: bool = False) -> DataFrame:
    """Hits with an account, a time and details, minus display hits,
    with the local date and wall clock of ``tz``; local dates in [start, end].

    The hit time is GMT without zone (timestamp_ntz). A one-day padded range
    on it goes first so the scan can skip row groups; the exact test is on
    the derived local date.
    """
    hit = F.col("post_cust_hit_time_gmt")
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), hit)
    details = F.col("post_evar7")
    df = raw.where(
        F.col("post_evar56").isNotNull() & hit.isNotNull() & details.isNotNull()
        & ~details.like("%display")
        & (hit >= _ts_literal(start - dt.timedelta(days=1)))
        & (hit < _ts_literal(end + dt.timedelta(days=2)))
    )
    cols = [
        F.col("post_evar56").alias(C.ACCOUNT),
        F.to_date(local).alias(C.DAY),
        local.alias(C.TIME),
        F.col("post_evar19").alias(C.PLAYER_EVENT),
        details.alias(C.DETAILS),
    ]
    if with_device:
        cols.append(device_family("post_evar37", "post_evar53", "post_evar106").alias(C.DEVICE))
    return df.select(*cols).where(F.col(C.DAY).between(F.lit(start), F.lit(end)))


def classify_clicks(clicks: DataFrame, brand: str, title: str | None = None,
                    device_like: str | None = None) -> DataFrame:
    """Timeline rows of the clicks that start a viewing.

    Optional scopes act here, before any LAG: ``title`` keeps clicks whose
    own title equals it in any case; ``device_like`` keeps one device family
    (a LIKE pattern on the lower-cased family).
    """
    has_device = C.DEVICE in clicks.columns
    rows = clicks.select(
        C.ACCOUNT, C.DAY, C.TIME, C.PLAYER_EVENT, C.DETAILS,
        start_type(C.DETAILS, C.PLAYER_EVENT).alias(C.START_TYPE),
        (F.col(C.DEVICE) if has_device else F.lit("")).alias(C.DEVICE),
        F.lit("").alias(C.FEEDER),
        F.lit("").alias(C.FEEDER_ID),
        clicked_title(C.DETAILS, C.PLAYER_EVENT, brand).alias(C.TITLE),
        F.lit("").alias(C.VIDEO_ID),
        F.lit(None).cast("bigint").alias(C.SECONDS),
    )
    keep = F.col(C.START_TYPE).isNotNull()
    if title is not None:
        keep = keep & (F.lower(C.TITLE) == F.lower(F.lit(title)))
    if device_like is not None:
        keep = keep & F.lower(C.DEVICE).like(device_like)
    return rows.where(keep)


def click_feeder(clicks: DataFrame, mode: str = "lag", tiebreak=(), parts: int | None = None) -> DataFrame:
    """Feeder of a click: the previous click's title in the same account-day
    (``lag``), or the blank string of the classified row (``blank``).

    The LAG runs on range partitions (``operators.carry``), so an account-day of any
    size is spread. ``tiebreak`` orders clicks at the same instant (default: by a
    hash of the row).
    """
    if mode == "blank":
        return clicks
    if mode != "lag":
        raise ValueError(f"unknown click feeder mode {mode!r}")
    keys = [C.ACCOUNT, C.DAY]
    dealt = deal(clicks.drop(C.FEEDER), keys, [C.TIME], tiebreak, parts, "clicks")
    lagged = carried_lags(together(dealt, keys), keys, [C.TIME], [(C.FEEDER, C.TITLE)], tiebreak=tiebreak)
    return lagged.select(*clicks.columns)
