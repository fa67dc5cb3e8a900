"""The kept viewing history equals a full recompute, and the reports that use it."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from conftest import SF_MID
from watchpath.operators.promo import already_watching, already_watching_since, merge_history, promo_accounts, viewer_history
from watchpath.operators.promo import prior_target_viewers, viewing_order
from watchpath.plans import params as P
from watchpath.plans.promo import cohort_events, promo_reach
from watchpath.plans.registry import tables
from watchpath.sources import LakeTables
from watchpath.streaming import load_history, merge_viewings, refresh_history
from watchpath.streaming.history import versions


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_daily_merges_and_late_files_equal_a_full_recompute(spark):
    root = tempfile.mkdtemp(prefix="watchpath-history-")
    t = tables(spark, SF_MID)
    video, days = t.video(), t.days()[1]
    cut = [days[0], days[9], days[19], days[-1]]
    lake = LakeTables(spark, f"{root}/clicks", f"{root}/video")

    def land(part):
        part.write.mode("append").partitionBy("adobe_date").parquet(f"{root}/video")

    def refresh():
        refresh_history(spark, lake, f"{root}/state", f"{root}/ckpt", P.PROMO_VIEW_TITLES, P.TARGET).awaitTermination(300)
        return rows(load_history(spark, f"{root}/state"))

    late = F.col("adobe_tracking_id").cast("long") % 4 == 0
    first = video.where(F.col("adobe_date") < F.lit(cut[1]))
    assert load_history(spark, f"{root}/state") is None
    land(first.where(~late))
    refresh()
    land(video.where(F.col("adobe_date").between(F.lit(cut[1]), F.lit(cut[2]))))
    refresh()
    land(first.where(late | late.isNull()))                            # late files of days merged before
    land(video.where(F.col("adobe_date") > F.lit(cut[2])))
    whole = rows(viewer_history(video, P.PROMO_VIEW_TITLES, P.TARGET))
    assert refresh() == whole and len(whole) > 10
    assert refresh() == whole                                          # nothing new
    merge_viewings(spark, f"{root}/state", first, P.PROMO_VIEW_TITLES, P.TARGET)
    assert rows(load_history(spark, f"{root}/state")) == whole         # a batch that is merged again
    assert len(versions(spark, f"{root}/state")) == 2


def test_an_unfinished_version_does_not_count(spark):
    import os

    path = tempfile.mkdtemp(prefix="watchpath-history-") + "/state"
    video = tables(spark, SF_MID).video()
    merge_viewings(spark, path, video, P.PROMO_VIEW_TITLES, P.TARGET)
    os.makedirs(f"{path}/version=7")
    assert versions(spark, path) == [0] and load_history(spark, path).count() > 0


def test_parts_merge_in_any_order(spark):
    video = tables(spark, SF_MID).video()
    part = lambda k: viewer_history(video.where(F.col("num_seconds_played_no_ads") % 3 == k), P.PROMO_VIEW_TITLES, P.TARGET)
    whole = rows(viewer_history(video, P.PROMO_VIEW_TITLES, P.TARGET))
    assert rows(merge_history(part(2), part(0), part(1), part(0))) == whole


def test_reports_from_the_kept_history(spark):
    t = tables(spark, SF_MID)
    start, end = t.scope()
    events = cohort_events(t, start, end, P.PROMO_ORIGINS, P.TARGET)
    viewers = prior_target_viewers(t.video(), promo_accounts(events), P.TARGET, start, end)
    want = already_watching(viewing_order(t.video(), events, viewers, P.PROMO_VIEW_TITLES, start, end), P.TARGET)
    history = viewer_history(t.video(), P.PROMO_VIEW_TITLES, P.TARGET)
    assert rows(already_watching_since(history, events)) == rows(want) and want.count() > 5
    args = (t, start, end, start, P.PROMO_ORIGINS, P.TARGET, P.PROMO_VIEW_TITLES)
    assert rows(promo_reach(*args, history=history)) == rows(promo_reach(*args))


def test_history_of_no_viewings(spark):
    empty = tables(spark, SF_MID).video().where(F.col("adobe_date") < F.lit(dt.date(1999, 1, 1)))
    assert viewer_history(empty, P.PROMO_VIEW_TITLES, P.TARGET).count() == 0
