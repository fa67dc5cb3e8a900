"""Promo cohort report: reach and hours of accounts sent to a target show."""

from __future__ import annotations

from watchpath.functions.dates import as_date
from watchpath.operators.promo import (
    already_watching,
    already_watching_since,
    cohort_usage,
    prior_target_viewers,
    promo_accounts,
    promo_events,
    promo_hourly_from,
    promo_reach_hours,
    video_lookup,
    viewing_order,
)
from watchpath.operators.joins import cohort
from watchpath.operators.order import published_order
from watchpath.session import materialize
from watchpath.sources.tables import Tables


def cohort_events(tables: Tables, start, end, origins, target: str,
                  cue_prefix: str | None = None):
    """Promo events of [start, end], materialised once (read by four steps)."""
    start, end = as_date(start), as_date(end)
    clicks = tables.clickstream(start, end)
    events = promo_events(clicks, video_lookup(clicks, start, end), origins, target,
                          start, end, cue_prefix)
    return materialize(events, "promo-events")


def excluded_accounts(tables: Tables, events, history_start, end, target: str, view_titles,
                      accounts=None, history=None):
    """Cohort accounts that were already watching. ``history``: a kept ``viewer_history`` of ``target`` and
    ``view_titles`` (see ``streaming.history``); with it no viewing is read again."""
    if history is not None:
        return already_watching_since(history, events)
    history_start, end = as_date(history_start), as_date(end)
    video = tables.video(history_start, end)
    accounts = accounts if accounts is not None else cohort(promo_accounts(events), "userid")
    viewers = prior_target_viewers(video, accounts, target, history_start, end)
    return already_watching(viewing_order(video, events, viewers, view_titles, history_start, end), target)


def _cohort(tables, start, end, history_start, origins, target, view_titles, cue_prefix=None, played_only=False, history=None):
    """Promo events, the cohort's usage and the excluded accounts."""
    start, end = as_date(start), as_date(end)
    events = cohort_events(tables, start, end, origins, target, cue_prefix)
    accounts = cohort(promo_accounts(events), "userid")       # written once, used twice
    usage = cohort_usage(tables.video(start, end), accounts, start, end, played_only)
    return events, usage, excluded_accounts(tables, events, history_start, end, target, view_titles, accounts, history)


def promo_reach(tables: Tables, start, end, history_start, origins, target: str,
                view_titles, cue_prefix: str | None = None, played_only: bool = False,
                ordered: bool = False, history=None, parts: int | None = None):
    """Reach and hours of the cohort's viewing of ``target`` after a promo event."""
    cohort = _cohort(tables, start, end, history_start, origins, target, view_titles, cue_prefix, played_only, history)
    return published_order(promo_reach_hours(*cohort, target, parts), "promo", ordered)


def promo_reach_hourly(tables: Tables, start, end, history_start, origins, target: str,
                       view_titles, history=None, parts: int | None = None):
    """The promo report per event hour and origin title."""
    cohort = _cohort(tables, start, end, history_start, origins, target, view_titles, history=history)
    return promo_hourly_from(*cohort, target, parts)
