"""Attributed timeline of one title: how each viewing started and how long
it was watched, credited to the head of its run."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from watchpath import columns as C
from watchpath.functions.dates import as_date
from watchpath.functions.labels import EASTERN
from watchpath.operators.clicks import classify_clicks, normalize_clicks
from watchpath.operators.order import published_order
from watchpath.operators.plays import play_rows
from watchpath.operators.timeline import (
    IS_PLAY,
    attribute,
    dealt_timeline,
    scope_by_feeder,
    sessionize,
    with_feeders,
)
from watchpath.sources.tables import Tables


def attributed_timeline(tables: Tables, start: str | dt.date, end: str | dt.date,
                        target: str, brand: str, scope: str = "display",
                        click_feeder_mode: str = "lag", tz: str = EASTERN,
                        ordered: bool = False, tiebreak=(), parts: int | None = None):
    """Timeline of ``target`` over [start, end], attributed row by row.

    ``scope="display"``: rows whose own title is the target; clicks are
    scoped before their LAG, plays after theirs (so a click's feeder can only
    be NULL or the target itself, a play's is the true previous title).
    ``scope="feeder"``: rows whose feeder is the target, after both LAGs.
    ``click_feeder_mode="blank"`` leaves click feeders as ''.

    Clicks and plays are dealt together, once, over range partitions of (account,
    day, time); all windows run on these and carry what crosses an edge
    (``operators.carry``), so an account-day of any size is spread. ``parts``: their number.
    ``ordered=True`` sorts by account, day and time as published. ``tiebreak`` (timeline
    column names) orders rows at the same instant for the three LAGs only; by
    default a hash of the row does.
    """
    if scope not in ("display", "feeder"):
        raise ValueError(f"unknown scope {scope!r}")
    start, end = as_date(start), as_date(end)
    clicks = normalize_clicks(tables.clickstream(start, end), start, end, tz)
    clicks = classify_clicks(clicks, brand, title=target if scope == "display" else None)
    dealt = dealt_timeline(clicks, play_rows(tables.video(start, end), start, end), tiebreak, parts)
    rows = with_feeders(dealt, click_feeder_mode, tiebreak)
    if scope == "display":                      # clicks are scoped already
        rows = rows.where(~F.col(IS_PLAY) | (F.lower(C.TITLE) == F.lower(F.lit(target))))
    else:
        rows = scope_by_feeder(rows, target)
    result = attribute(sessionize(rows, tiebreak, dealt=dealt))
    return published_order(result, "attributed", ordered)
