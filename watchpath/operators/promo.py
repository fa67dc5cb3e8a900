"""Promo cohort: accounts sent by a cue-up from some shows to a target show,
their later viewing of it, minus accounts that were already watching.

No step pairs rows of one account with each other: a viewing's rank among the
pairs of viewings and promo events is computed from counts, and the "usage
after an event" credit counts events with an ordered window over the union
of events and usage. Both windows run on range partitions (``operators.carry``).
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from watchpath.functions.hours import hour_hundredths, round_hours
from watchpath.functions.labels import PROMO_CLOCK_SHIFT_HOURS, PROMO_LEAD_MINUTES
from watchpath.functions.titles import clean_title_promo
from watchpath.operators.joins import cohort, join_small
from watchpath.operators.carry import carried_sums, deal

ACCOUNT = "adobe_tracking_id"


def video_lookup(clicks: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Most frequent metadata per video id (ties kept): show, binge-from title."""
    c = clicks.where(F.col("adobe_date_est").between(F.lit(start), F.lit(end))
                     & F.col("post_evar28").isNotNull() & F.col("post_prop21").isNotNull())
    g = (c.groupBy("post_evar28", "post_prop21", "post_evar72")
         .agg(F.count("post_evar56").alias("uid_count")))
    w = Window.partitionBy("post_prop21").orderBy(F.desc("uid_count"))
    return (g.withColumn("day_rank", F.rank().over(w)).where(F.col("day_rank") == 1)
            .select(F.col("post_evar28").alias("show_title"),
                    F.col("post_evar72").alias("lookup_title"),
                    F.col("post_prop21").alias("vid")))


def promo_events(clicks: DataFrame, lookup: DataFrame, origins, target: str,
                 start: dt.date, end: dt.date, cue_prefix: str | None = None) -> DataFrame:
    """Cue-up hits from the ``origins`` shows (LIKE patterns on the lower-cased
    show) whose click path names ``target`` (any case, literally), enriched through the lookup by
    the 5th pipe field of the cue-up string. One row per (hit, tied lookup row).
    """
    show, path = F.lower("post_evar28"), F.lower("post_prop15")
    from_origin = reduce(lambda a, b: a | b, [show.like(o) for o in origins])
    keep = (F.col("adobe_date_est").between(F.lit(start), F.lit(end))
            & F.col("post_prop47").isNotNull() & F.col("post_evar56").isNotNull()
            & from_origin & ~show.like("%trailer%")
            & path.contains(F.lower(F.lit(target))) & ~path.like("%trailer%")
            & (F.col("post_prop15").like("%|click") | F.col("post_prop15").like("%|auto-play")))
    if cue_prefix is not None:
        keep = keep & F.col("post_prop47").like(f"{cue_prefix}%")
    hits = clicks.where(keep).select(
        (F.col("RevisedTimeStamp") - F.make_dt_interval(hours=F.lit(PROMO_CLOCK_SHIFT_HOURS)))
        .alias("RevisedTimeStamp1"),
        "post_prop47", "post_evar72",
        F.get(F.split("post_prop47", "[|]"), 4).alias("vid"),
        F.col("post_evar56").alias("userid"),
    )
    titles = lookup.where(F.col("lookup_title").isNotNull()).select(
        "vid", F.col("lookup_title").alias("show2"))
    return join_small(hits, titles, "vid", "inner")


def promo_accounts(events: DataFrame) -> DataFrame:
    return events.select("userid").distinct()


def _of_cohort(video: DataFrame, accounts: DataFrame) -> DataFrame:
    """Viewing rows of a ``userid`` account list (a ``joins.cohort``, or any list)."""
    return video.join(accounts, F.col(ACCOUNT) == F.col("userid"), "left_semi")


def cohort_usage(video: DataFrame, accounts: DataFrame, start: dt.date, end: dt.date,
                 played_only: bool = False) -> DataFrame:
    """Hours per (record time, account, lower-cased program) of cohort
    accounts, rounded to whole hours per group (before any later sum)."""
    keep = F.col("adobe_date").between(F.lit(start), F.lit(end)) & (F.col("num_views_started") > 0)
    if played_only:
        keep = keep & (F.col("num_seconds_played_no_ads") > 0)
    v = _of_cohort(video.where(keep), accounts)
    # grouped by (time, account, program), not partitioned by account first:
    # one very active account must not land in a single task
    return (v.groupBy("adobe_timestamp", ACCOUNT, F.lower("program").alias("theshow"))
            .agg(round_hours(F.sum("num_seconds_played_no_ads"), 0).alias("hours_watched")))


def prior_target_viewers(video: DataFrame, accounts: DataFrame, target: str,
                         since: dt.date, end: dt.date) -> DataFrame:
    """Cohort accounts that started ``target`` in [since, end]."""
    v = video.where(F.col("adobe_date").between(F.lit(since), F.lit(end))
                    & (F.col("num_views_started") > 0)
                    & (F.lower("display_name") == F.lower(F.lit(target))))
    return _of_cohort(v, accounts).select(ACCOUNT).distinct()


def _prior_views(video: DataFrame, titles, since: dt.date, end: dt.date) -> DataFrame:
    """Started and played viewings of ``titles`` (any case) in [since, end]."""
    titles = [t.lower() for t in titles]
    return video.where(F.col("adobe_date").between(F.lit(since), F.lit(end))
                       & (F.col("num_views_started") > 0)
                       & (F.col("num_seconds_played_no_ads") > 0)
                       & F.lower("display_name").isin(*titles))


def viewing_order(video: DataFrame, events: DataFrame, viewers: DataFrame, titles,
                  since: dt.date, end: dt.date) -> DataFrame:
    """The prior viewers' viewings of ``titles``, ranked: a row per (account, time, title).

    As published, every viewing is paired with every promo event of its account and
    the pairs (account, viewing time, title, event time) are ranked by viewing time,
    so ``day_rank`` = 1 + (the account's earlier viewings) x (its distinct event
    times); it is the same for all pairs of a viewing, and no pair is formed. The row of
    a viewing is its pair with the latest event: ``bingetime``, and ``hours_watched`` once per
    event row of that time (rounded to 2 decimals).
    """
    v = _prior_views(video, titles, since, end).join(cohort(viewers, ACCOUNT), ACCOUNT, "left_semi")
    views = (v.groupBy(ACCOUNT, F.col("adobe_timestamp").alias("jtimestamp"), "display_name")
             .agg(F.sum("num_seconds_played_no_ads").alias("_s")))
    # a row per instant, so no two rows of the running count tie; titles at one instant are spellings of the list
    instants = (views.groupBy(ACCOUNT, "jtimestamp")
                .agg(F.count(F.lit(1)).alias("_n"), F.collect_list(F.struct("display_name", "_s")).alias("_views")))
    counted = carried_sums(deal(instants, [ACCOUNT], ["jtimestamp"], name="viewings"), [ACCOUNT], ["jtimestamp"],
                           [("_upto", F.col("_n"))])
    times = (events.groupBy(F.col("userid").alias(ACCOUNT), "RevisedTimeStamp1").agg(F.count(F.lit(1)).alias("_rows"))
             .groupBy(ACCOUNT).agg(F.count(F.lit(1)).alias("_times"), F.max("RevisedTimeStamp1").alias("bingetime"),
                                   F.max_by("_rows", "RevisedTimeStamp1").alias("_latest")))
    rows = join_small(counted, times, ACCOUNT, "inner").select(
        ACCOUNT, "jtimestamp", F.explode("_views").alias("_v"), "bingetime", "_latest",
        (1 + (F.col("_upto") - F.col("_n")) * F.col("_times")).alias("day_rank"))
    return rows.select(ACCOUNT, "jtimestamp", "_v.display_name", "bingetime",
                       (hour_hundredths(F.col("_v._s") * F.col("_latest")) / F.lit(100)).cast("double").alias("hours_watched"),
                       "day_rank")


def already_watching(order: DataFrame, target: str) -> DataFrame:
    """Accounts with a viewing of ``target`` that came first or preceded a promo event."""
    is_target = F.lower("display_name") == F.lower(F.lit(target))
    return (order.where(is_target & ((F.col("day_rank") == 1) | (F.col("jtimestamp") < F.col("bingetime"))))
            .select(ACCOUNT).distinct())


def viewer_history(video: DataFrame, titles, target: str, since: dt.date | None = None,
                   end: dt.date | None = None) -> DataFrame:
    """Per account: ``started_target`` (it started ``target``), ``first_view`` and ``first_target_view`` (its
    first played viewing among ``titles``, and of ``target``).

    All ``already_watching`` needs of the history. Parts of the history merge to the history of
    the whole (``merge_history``), in any order and also when a part comes twice.
    """
    if since is not None:
        video = video.where(F.col("adobe_date") >= F.lit(since))
    if end is not None:
        video = video.where(F.col("adobe_date") <= F.lit(end))
    title = F.lower("display_name")
    is_target, listed = title == target.lower(), title.isin(*[t.lower() for t in titles])
    v = video.where(F.col(ACCOUNT).isNotNull() & (F.col("num_views_started") > 0) & (is_target | listed))
    time = F.when((F.col("num_seconds_played_no_ads") > 0) & listed, F.col("adobe_timestamp"))
    return v.groupBy(ACCOUNT).agg(F.max(is_target).alias("started_target"), F.min(time).alias("first_view"),
                                  F.min(F.when(is_target, time)).alias("first_target_view"))


def merge_history(*parts: DataFrame) -> DataFrame:
    return (reduce(DataFrame.unionByName, parts).groupBy(ACCOUNT)
            .agg(F.max("started_target").alias("started_target"), F.min("first_view").alias("first_view"),
                 F.min("first_target_view").alias("first_target_view")))


def already_watching_since(history: DataFrame, events: DataFrame) -> DataFrame:
    """``already_watching`` from a kept ``viewer_history`` instead of the viewings: promo accounts only."""
    last = events.groupBy(F.col("userid").alias(ACCOUNT)).agg(F.max("RevisedTimeStamp1").alias("last_promo"))
    target = F.col("first_target_view")
    return (join_small(history.where("started_target"), last, ACCOUNT, "inner")
            .where((target == F.col("first_view")) | (target < F.col("last_promo"))).select(ACCOUNT))


def _promo_timeline(events: DataFrame, usage: DataFrame, excluded: DataFrame, target: str,
                    event_cols=(), parts: int | None = None) -> DataFrame:
    """Promo events (of accounts not excluded) and cohort usage of titles
    containing ``target`` as one (account, title) timeline, dealt over range partitions.

    Events are placed ``PROMO_LEAD_MINUTES`` early, so "usage after the
    event minus the lead" becomes "later on the timeline"; kind 1 = event,
    0 = usage, and usage sorts first at equal times (the bound is strict).
    """
    ev_title = clean_title_promo("show2")
    ev = events.where((F.col("show2") != F.col("post_evar72")) & ev_title.contains(clean_title_promo(F.lit(target))))
    ev = join_small(ev, excluded, F.col("userid") == F.col(ACCOUNT), "left_anti")
    ev = ev.select(
        F.col("userid").alias("_acct"), ev_title.alias("_title"),
        (F.col("RevisedTimeStamp1") - F.make_dt_interval(mins=F.lit(PROMO_LEAD_MINUTES))).alias("_t"),
        F.lit(1).alias("_ev"), F.lit(None).cast("double").alias("_hours"),
        *[c.alias(name) for name, c, _ in event_cols])
    us_title = clean_title_promo("theshow")
    us = usage.where(us_title.contains(clean_title_promo(F.lit(target)))).select(
        F.col(ACCOUNT).alias("_acct"), us_title.alias("_title"),
        F.col("adobe_timestamp").alias("_t"), F.lit(0).alias("_ev"),
        F.col("hours_watched").alias("_hours"),
        *[F.lit(None).cast(kind).alias(name) for name, _, kind in event_cols])
    return deal(ev.unionByName(us), PROMO_KEYS, PROMO_ORDER, parts=parts, name="promo-timeline")


PROMO_KEYS, PROMO_ORDER = ["_acct", "_title"], ["_t", "_ev"]


def promo_reach_hours(events: DataFrame, usage: DataFrame, excluded: DataFrame,
                      target: str, parts: int | None = None) -> DataFrame:
    """Reach and hours per (promoted title, watched title).

    A usage row counts for every promo event of the same account and title
    placed less than ``PROMO_LEAD_MINUTES`` after it, and its hours are
    credited once per such event (as published). Events of excluded
    accounts are dropped. The count of qualifying events per usage row is a
    running sum over the account-title timeline (RANGE frame over time and
    kind: a usage row sees the events strictly before it).
    """
    timeline = _promo_timeline(events, usage, excluded, target, parts=parts)
    credited = (carried_sums(timeline, PROMO_KEYS, PROMO_ORDER, [("_events_before", F.col("_ev"))])
                .where((F.col("_ev") == 0) & (F.col("_events_before") > 0)))
    return (credited.groupBy("_title")
            .agg(F.countDistinct("_acct").alias("Reach"),
                 F.sum(F.col("_hours") * F.col("_events_before")).alias("Hours"))
            .select(F.col("_title").alias("Binge_To"), F.col("_title").alias("Show_Watched"),
                    "Reach", "Hours"))


def _hour_ntz(ts):
    """Wall-clock hour of a timestamp_ntz, without any zone (date_trunc would
    go through the session zone and return a zoned timestamp)."""
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts),
                                F.lit(0), F.lit(0))


def promo_hourly_from(events: DataFrame, usage: DataFrame, excluded: DataFrame, target: str,
                      parts: int | None = None) -> DataFrame:
    """Reach and hours per (event hour, origin title, promoted title, watched title).

    Same credit as ``promo_reach_hours``, seen from the events: an event
    gets the hours of every later usage row of its account and title, i.e.
    the title's totals minus the running sums up to the event (both from one
    pass). Reach counts accounts with an event that has later usage; hours stay
    NULL when every credited usage row has NULL hours, as a SUM over the pairs would.
    """
    event_cols = [("Binge_Hour", _hour_ntz(F.col("RevisedTimeStamp1")), "timestamp_ntz"),
                  ("Binge_From", clean_title_promo("post_evar72"), "string")]
    timeline = _promo_timeline(events, usage, excluded, target, event_cols, parts)
    use = (F.col("_ev") == 0).cast("long")
    sums = [("h", F.coalesce("_hours", F.lit(0.0)) * use), ("n", use),
            ("k", (F.col("_hours").isNotNull() & (F.col("_ev") == 0)).cast("long"))]
    scanned = carried_sums(timeline, PROMO_KEYS, PROMO_ORDER, [(f"_{n}_upto", e) for n, e in sums],
                           [(f"_{n}_all", e) for n, e in sums])
    per_event = scanned.where(F.col("_ev") == 1).select(
        "_acct", "Binge_Hour", "Binge_From", "_title",
        *[(F.col(f"_{n}_all") - F.col(f"_{n}_upto")).alias(f"_{n}_after") for n, _ in sums])
    return (per_event.where(F.col("_n_after") > 0)
            .groupBy("Binge_Hour", "Binge_From", "_title")
            .agg(F.countDistinct("_acct").alias("Reach"), F.sum("_h_after").alias("_h"),
                 F.sum("_k_after").alias("_k"))
            .select("Binge_Hour", "Binge_From", F.col("_title").alias("Binge_To"),
                    F.col("_title").alias("Show_Watched"), "Reach",
                    F.when(F.col("_k") > 0, F.col("_h")).alias("Hours")))
