"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

One key per operator of the inventory. Each query reads the stand-in
tables of ``sf_dir`` over every day they hold (see ``params``); keys of
Column expressions return their inputs with the result, one row per
source row.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from watchpath import columns as C
from watchpath.functions.dates import DateScope
from watchpath.functions.devices import device_family
from watchpath.functions.rules import attributed_start_type, new_watch_time
from watchpath.functions.titles import (
    clean_title,
    clean_title_promo,
    clicked_title,
    series_or_null,
    start_type,
)
from watchpath.operators import feeders as FD
from watchpath.operators import promo as PR
from watchpath.operators import share as SH
from watchpath.operators.clicks import click_feeder, classify_clicks, normalize_clicks
from watchpath.operators.plays import play_events
from watchpath.operators.timeline import (
    merge_timeline,
    scope_by_feeder,
    scope_by_title,
    sessionize,
)
from watchpath.plans import feeders as PF
from watchpath.plans import params as P
from watchpath.plans import promo as PP
from watchpath.plans.attribution import attributed_timeline
from watchpath.session import checkpoint_dir
from watchpath.sources.standin import PLAYER_EVENT_BRAND as BRAND
from watchpath.sources.standin import materialized
from watchpath.sources.store import load_attributed, save_attributed

Query = Callable[[SparkSession, str], DataFrame]


def tables(spark: SparkSession, sf_dir: str):
    return materialized(spark, sf_dir)


def scope(spark: SparkSession, sf_dir: str) -> DateScope:
    """Every day of the tables."""
    return tables(spark, sf_dir).scope()


def attributed(s, d, kind="display", feeder="lag") -> DataFrame:
    return attributed_timeline(tables(s, d), *scope(s, d), P.TARGET, BRAND, scope=kind, click_feeder_mode=feeder)


def q_date_scope(s, d):
    """Every day of the scope, with the tables that hold it."""
    t = tables(s, d)
    (start, end), (clicks, views) = t.scope(), t.days()
    days = s.createDataFrame([(start, end)], "scope_start date, scope_end date").select(
        F.explode(F.sequence("scope_start", "scope_end")).alias("day"), "scope_start", "scope_end")
    held = lambda some: F.col("day").isin(*some) if some else F.lit(False)
    return days.select("day", held(clicks).alias("has_clicks"), held(views).alias("has_views"), "scope_start", "scope_end")


# --- click and play sides -------------------------------------------------

def q_click_normalize(s, d):
    t = tables(s, d)
    return normalize_clicks(t.clickstream(*scope(s, d)), *scope(s, d))


def q_device_normalize(s, d):
    raw = tables(s, d).clickstream()
    return raw.select("post_evar37", "post_evar53", "post_evar106",
                      device_family("post_evar37", "post_evar53", "post_evar106").alias(C.DEVICE))


def q_start_type_classify(s, d):
    raw = tables(s, d).clickstream()
    return raw.select("post_evar7", "post_evar19",
                      start_type("post_evar7", "post_evar19").alias(C.START_TYPE))


def q_title_extract(s, d):
    raw = tables(s, d).clickstream()
    return raw.select("post_evar7", "post_evar19",
                      clicked_title("post_evar7", "post_evar19", BRAND).alias(C.TITLE))


def q_classified_clicks(s, d):
    return classify_clicks(q_click_normalize(s, d), BRAND)


def q_click_device_scope(s, d):
    t = tables(s, d)
    clicks = normalize_clicks(t.clickstream(*scope(s, d)), *scope(s, d), with_device=True)
    return classify_clicks(clicks, BRAND, device_like=P.DEVICE_LIKE)


def q_click_feeder(s, d):
    return click_feeder(q_classified_clicks(s, d))


def q_click_feeder_blank(s, d):
    clicks = classify_clicks(q_click_normalize(s, d), BRAND, title=P.TARGET)
    return click_feeder(clicks, "blank")


def q_play_events(s, d):
    return play_events(tables(s, d).video(*scope(s, d)), *scope(s, d))


def q_scope_by_title(s, d):
    return scope_by_title(q_play_events(s, d), P.TARGET)


def q_scope_by_feeder(s, d):
    return merge_timeline(scope_by_feeder(q_click_feeder(s, d), P.TARGET),
                          scope_by_feeder(q_play_events(s, d), P.TARGET))


def _display_timeline(s, d):
    clicks = click_feeder(classify_clicks(q_click_normalize(s, d), BRAND, title=P.TARGET))
    return merge_timeline(clicks, q_scope_by_title(s, d))


def q_merge_timeline(s, d):
    return _display_timeline(s, d)


def q_last_action(s, d):
    return sessionize(_display_timeline(s, d)).select(*C.TIMELINE, C.LAST_ACTION)


def q_episode_runs(s, d):
    return sessionize(_display_timeline(s, d)).select(*C.TIMELINE, C.RUN)


def q_episode_time(s, d):
    return sessionize(_display_timeline(s, d)).select(*C.TIMELINE, C.RUN, C.EPISODE_TIME)


def _rule_inputs():
    return [C.ACCOUNT, C.DAY, C.TIME, C.LAST_ACTION, C.FEEDER, C.TITLE, C.SECONDS, C.EPISODE_TIME]


def q_attribute_start_type(s, d):
    sess = sessionize(_display_timeline(s, d))
    return sess.select(*_rule_inputs(), F.col(C.START_TYPE).alias("Raw_Start_Type"),
                       attributed_start_type().alias(C.START_TYPE))


def q_new_watch_time(s, d):
    sess = sessionize(_display_timeline(s, d))
    return sess.select(*_rule_inputs(), new_watch_time().alias(C.WATCH_TIME))


def q_save_attributed(s, d):
    path = f"{checkpoint_dir(s).rstrip('/')}/attributed-feeder-{uuid.uuid4().hex}"
    save_attributed(attributed(s, d, "feeder"), path)
    return load_attributed(s, path)


# --- share reports ---------------------------------------------------------

def q_daily_hours(s, d):
    return SH.daily_hours(attributed(s, d, "feeder"))


def q_autoplay_destination(s, d):
    return SH.autoplay_destinations(attributed(s, d, "feeder"), P.DESTINATIONS)


def q_autoplay_share(s, d):
    return SH.autoplay_share(attributed(s, d, "feeder"), P.DESTINATIONS)


def q_minor_feeder_fold(s, d):
    return SH.fold_minor_feeders(attributed(s, d, "feeder"), P.DESTINATIONS)


def q_daily_start_type_totals(s, d):
    return SH.daily_start_type_totals(attributed(s, d, "display", "blank"))


# --- feeder series ---------------------------------------------------------

def _video_rows(s, d):
    return tables(s, d).video()


def q_clean_title(s, d):
    v = _video_rows(s, d)
    return v.select("display_name", clean_title("display_name").alias("clean_title"))


def q_clean_title_promo(s, d):
    v = _video_rows(s, d)
    return v.select("program", clean_title_promo("program").alias("clean_title"))


def q_reject_station_names(s, d):
    v = _video_rows(s, d)
    return v.select("display_name", series_or_null("display_name").alias("Series"))


def q_episode_series_counts(s, d):
    return FD.episode_series_counts(tables(s, d).video(*scope(s, d)), *scope(s, d))


def q_episode_series_map(s, d):
    return PF.series_map(tables(s, d), *scope(s, d), per_day=True)


def _feeder_combos(s, d):
    t = tables(s, d)
    return FD.feeder_to_series(PF.feeder_clicks(t, *scope(s, d), BRAND),
                               PF.series_map(t, *scope(s, d)))


def q_feeder_to_series(s, d):
    return _feeder_combos(s, d)


def q_series_cue_filter(s, d):
    return FD.series_cue_only(_feeder_combos(s, d))


def q_exclude_linear_channels(s, d):
    t = tables(s, d)
    return FD.exclude_channels(FD.series_cue_only(_feeder_combos(s, d)),
                               FD.linear_channels(t.video(*scope(s, d)), *scope(s, d)))


def q_conditional_reach(s, d):
    return PF.feeder_reach(tables(s, d), *scope(s, d), BRAND)


def q_top_feeders_daily(s, d):
    return PF.top_feeders_daily(tables(s, d), *scope(s, d), BRAND, P.TOP_K)


def q_device_feed_list(s, d):
    return PF.device_feed_list(tables(s, d), *scope(s, d), *scope(s, d), P.DEVICE_LIKE, BRAND)


def q_feeder_destination_pairs(s, d):
    return PF.feeder_destination_pairs(tables(s, d), *scope(s, d), BRAND, device_like=P.DEVICE_LIKE)


def q_device_top_feeders(s, d):
    return PF.device_top_feeders(tables(s, d), *scope(s, d), P.DEVICE_LIKE, BRAND, P.TOP_K)


# --- promo cohort ----------------------------------------------------------

def q_video_id_lookup(s, d):
    t = tables(s, d)
    return PR.video_lookup(t.clickstream(*scope(s, d)), *scope(s, d))


def _events(s, d):
    return PP.cohort_events(tables(s, d), *scope(s, d), P.PROMO_ORIGINS, P.TARGET)


def q_promo_binge_events(s, d):
    return _events(s, d)


def q_promo_accounts(s, d):
    return PR.promo_accounts(_events(s, d))


def q_cohort_usage(s, d):
    t = tables(s, d)
    return PR.cohort_usage(t.video(*scope(s, d)), PR.promo_accounts(_events(s, d)),
                           *scope(s, d))


def q_prior_target_viewers(s, d):
    t = tables(s, d)
    return PR.prior_target_viewers(t.video(*scope(s, d)), PR.promo_accounts(_events(s, d)),
                                   P.TARGET, *scope(s, d))


def q_viewing_order(s, d):
    t = tables(s, d)
    events = _events(s, d)
    video = t.video(*scope(s, d))
    viewers = PR.prior_target_viewers(video, PR.promo_accounts(events), P.TARGET,
                                      *scope(s, d))
    return PR.viewing_order(video, events, viewers, P.PROMO_VIEW_TITLES, *scope(s, d))


def q_already_watching(s, d):
    return PR.already_watching(q_viewing_order(s, d), P.TARGET)


def q_promo_reach_hours(s, d):
    return PP.promo_reach(tables(s, d), *scope(s, d), scope(s, d).start, P.PROMO_ORIGINS,
                          P.TARGET, P.PROMO_VIEW_TITLES)


def q_promo_hourly_from(s, d):
    return PP.promo_reach_hourly(tables(s, d), *scope(s, d), scope(s, d).start, P.PROMO_ORIGINS,
                                 P.TARGET, P.PROMO_VIEW_TITLES)


def q_optional_predicates(s, d):
    return PP.promo_reach(tables(s, d), *scope(s, d), scope(s, d).start, P.PROMO_ORIGINS,
                          P.TARGET, P.PROMO_VIEW_TITLES, cue_prefix=P.CUE_PREFIX,
                          played_only=True)


def queries() -> dict[str, Query]:
    return {
        "date_scope": q_date_scope,
        "click_normalize": q_click_normalize,
        "device_normalize": q_device_normalize,
        "start_type_classify": q_start_type_classify,
        "title_extract": q_title_extract,
        "classified_clicks": q_classified_clicks,
        "click_device_scope": q_click_device_scope,
        "click_feeder": q_click_feeder,
        "click_feeder_blank": q_click_feeder_blank,
        "play_events": q_play_events,
        "scope_by_title": q_scope_by_title,
        "scope_by_feeder": q_scope_by_feeder,
        "merge_timeline": q_merge_timeline,
        "last_action": q_last_action,
        "episode_runs": q_episode_runs,
        "episode_time": q_episode_time,
        "attribute_start_type": q_attribute_start_type,
        "new_watch_time": q_new_watch_time,
        "attributed_timeline_display": lambda s, d: attributed(s, d, "display", "lag"),
        "attributed_timeline_blank": lambda s, d: attributed(s, d, "display", "blank"),
        "attributed_timeline_feeder": lambda s, d: attributed(s, d, "feeder", "lag"),
        "save_attributed": q_save_attributed,
        "daily_total_watch_hours": q_daily_hours,
        "autoplay_destination": q_autoplay_destination,
        "autoplay_share": q_autoplay_share,
        "clean_title": q_clean_title,
        "clean_title_promo": q_clean_title_promo,
        "reject_station_names": q_reject_station_names,
        "episode_series_counts": q_episode_series_counts,
        "episode_series_map": q_episode_series_map,
        "feeder_to_series": q_feeder_to_series,
        "series_cue_filter": q_series_cue_filter,
        "exclude_linear_channels": q_exclude_linear_channels,
        "conditional_reach": q_conditional_reach,
        "top_feeders_daily": q_top_feeders_daily,
        "device_feed_list": q_device_feed_list,
        "video_id_lookup": q_video_id_lookup,
        "promo_binge_events": q_promo_binge_events,
        "promo_accounts": q_promo_accounts,
        "cohort_usage": q_cohort_usage,
        "prior_target_viewers": q_prior_target_viewers,
        "viewing_order": q_viewing_order,
        "already_watching": q_already_watching,
        "promo_reach_hours": q_promo_reach_hours,
        "daily_start_type_totals": q_daily_start_type_totals,
        "feeder_destination_pairs": q_feeder_destination_pairs,
        "device_top_feeders": q_device_top_feeders,
        "minor_feeder_fold": q_minor_feeder_fold,
        "promo_hourly_from": q_promo_hourly_from,
        "optional_predicates": q_optional_predicates,
    }
