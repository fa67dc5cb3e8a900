"""Hand-made rows for the edge cases of the timeline."""

import datetime as dt

from watchpath import columns as C
from watchpath.operators.clicks import normalize_clicks
from watchpath.operators.plays import play_events
from watchpath.operators.timeline import attribute, sessionize

T = dt.datetime
TL_SCHEMA = (f"{C.ACCOUNT} string, {C.DAY} date, {C.TIME} timestamp_ntz, {C.PLAYER_EVENT} string, "
             f"{C.DETAILS} string, {C.START_TYPE} string, {C.DEVICE} string, {C.FEEDER} string, "
             f"{C.FEEDER_ID} string, {C.TITLE} string, {C.VIDEO_ID} string, {C.SECONDS} bigint")
D = dt.date(2024, 1, 5)


def row(ts, kind, feeder, title, secs):
    return ("a", D, ts, "", "", kind, "", feeder, "", title, "", secs)


def run(spark, rows):
    df = spark.createDataFrame(rows, TL_SCHEMA)
    out = attribute(sessionize(df)).orderBy(C.TIME, C.TITLE).collect()
    return [(r[C.START_TYPE], r[C.WATCH_TIME]) for r in out]


def test_eastern_dates_and_dst(spark):
    raw = spark.createDataFrame([
        ("u", T(2022, 11, 6, 5, 30), "rail|A|click", "p"),
        ("u", T(2022, 11, 6, 6, 30), "rail|A|click", "p"),
        ("u", T(2023, 1, 10, 3, 0), "rail|A|click", "p"),
        ("u", T(2023, 1, 10, 3, 0), "rail|A|display", "p"),
        (None, T(2023, 1, 10, 3, 0), "rail|A|click", "p"),
    ], "post_evar56 string, post_cust_hit_time_gmt timestamp_ntz, post_evar7 string, post_evar19 string")
    out = normalize_clicks(raw, dt.date(2022, 11, 1), dt.date(2023, 1, 31)).orderBy(C.TIME).collect()
    assert [(r[C.DAY], r[C.TIME]) for r in out] == [
        (dt.date(2022, 11, 6), T(2022, 11, 6, 1, 30)),
        (dt.date(2022, 11, 6), T(2022, 11, 6, 1, 30)),
        (dt.date(2023, 1, 9), T(2023, 1, 9, 22, 0)),
    ]


def test_shift_keeps_the_day(spark):
    video = spark.createDataFrame([
        ("u", dt.date(2024, 1, 5), T(2024, 1, 5, 0, 0, 10), "Roku", "A", "v1", 100, 100, False),
        ("u", dt.date(2024, 1, 5), T(2024, 1, 5, 0, 30), "Roku", "A trailer", "v2", 10, 0, False),
        ("u", dt.date(2024, 1, 5), T(2024, 1, 5, 1, 0), "Roku", "B", "v3", 10, 10, None),
    ], "adobe_tracking_id string, adobe_date date, adobe_timestamp timestamp_ntz, device_name string, "
       "display_name string, video_id string, num_seconds_played_no_ads bigint, "
       "num_seconds_played_with_ads bigint, media_load boolean")
    out = play_events(video, D, D).collect()
    assert len(out) == 1                      # no seconds with ads / unknown preload are dropped
    r = out[0]
    assert r[C.DAY] == D and r[C.TIME] == T(2024, 1, 4, 23, 59, 30)
    assert r[C.START_TYPE] == "Vdo_End" and r[C.FEEDER] is None


def test_rule_outcomes_on_a_timeline(spark):
    rows = [
        row(T(2024, 1, 5, 10, 0), "Auto-Play", "", "A", None),      # blank feeder click, head
        row(T(2024, 1, 5, 10, 1), "Vdo_End", "X", "A", 100),        # prev Auto-Play -> R4
        row(T(2024, 1, 5, 10, 2), "Vdo_End", "A", "A", 50),         # continuation: R10, credit 0
        row(T(2024, 1, 5, 11, 0), "Vdo_End", "A", "alpha", 20),     # case change: head, prev Vdo_End
    ]
    got = run(spark, rows)
    # the click is a head ('' <> 'A'); the first play (feeder X) heads the next run
    assert got[0] == ("Manual-Selection", 0)       # R9 ('' feeder auto-play); '' <> 'A' head, no secs
    assert got[1] == ("Auto-Play", 150)            # R4; head of run with the 50 s continuation
    assert got[2] == ("Vdo_End", 0)
    assert got[3] == ("Auto-Play", 20)             # R7: feeder A <> alpha, ep 0, 20 s <= 30


def test_ties_share_a_run(spark):
    t = T(2024, 1, 5, 10, 0)
    rows = [
        row(t, "Vdo_End", "A", "A", 40),        # continuation at the same instant as a head
        row(t, "Vdo_End", "X", "A", 60),        # head
    ]
    df = spark.createDataFrame(rows, TL_SCHEMA)
    s = sessionize(df).collect()
    assert {r[C.RUN] for r in s} == {1}          # RANGE frame: tied rows share the run id
    assert {r[C.EPISODE_TIME] for r in s} == {40}


def test_orphaned_run_has_null_episode_time(spark):
    rows = [
        row(T(2024, 1, 5, 9, 0), "Vdo_End", "A", "A", 30),          # continuation first: run 0
        row(T(2024, 1, 5, 9, 5), "Manual-Selection", "A", "A", None),
    ]
    df = spark.createDataFrame(rows, TL_SCHEMA)
    s = sessionize(df).collect()
    assert {r[C.RUN] for r in s} == {0}
    assert {r[C.EPISODE_TIME] for r in s} == {30}
    only_clicks = spark.createDataFrame([row(T(2024, 1, 5, 9, 0), "Dismiss", "A", "A", None)], TL_SCHEMA)
    assert sessionize(only_clicks).first()[C.EPISODE_TIME] is None
    w = attribute(sessionize(only_clicks)).first()[C.WATCH_TIME]
    assert w == 0                                  # continuation row: credit 0 regardless


def test_blank_and_null_feeders_differ(spark):
    rows = [
        ("a", D, T(2024, 1, 5, 8, 0), "", "", "Vdo_End", "", None, "", "A", "", 10),
        ("b", D, T(2024, 1, 5, 8, 0), "", "", "Vdo_End", "", "", "", "A", "", 10),
    ]
    df = spark.createDataFrame(rows, TL_SCHEMA)
    out = {r[C.ACCOUNT]: r[C.START_TYPE] for r in attribute(sessionize(df)).collect()}
    assert out == {"a": "Manual-Selection", "b": "Vdo_End"}     # R1 vs '' failing R6-R8


def test_tied_series_duplicate_the_click(spark):
    from watchpath.operators.feeders import episode_series_map, feeder_to_series

    counts = spark.createDataFrame(
        [(D, "ep one", "series a", 5), (D, "ep one", "series b", 5), (D, "ep one", "series c", 2)],
        f"{C.DAY} date, Episode string, Series string, Display_Time bigint")
    mapping = episode_series_map(counts)
    assert sorted(r.Series for r in mapping.collect()) == ["series a", "series b"]
    clicks = spark.createDataFrame([row(T(2024, 1, 5, 9, 0), "Auto-Play", "Ep: One!", "B", None),
                                    row(T(2024, 1, 5, 9, 1), "Auto-Play", "Other.", "C", None)],
                                   TL_SCHEMA)
    got = sorted((r[C.FEEDER], r.Combination) for r in feeder_to_series(clicks, mapping).collect())
    assert got == [("Ep: One!", "series a"), ("Ep: One!", "series b"), ("Other.", "other")]


def test_zero_day_total_gives_null_share(spark):
    from watchpath.operators.share import autoplay_share

    attributed = spark.createDataFrame(
        [("a", D, T(2024, 1, 5, 9, 0), None, "Auto-Play", "", "X", "", "Dest", "", 0, 0)],
        f"{C.ACCOUNT} string, {C.DAY} date, {C.TIME} timestamp_ntz, {C.LAST_ACTION} string, "
        f"{C.START_TYPE} string, {C.DEVICE} string, {C.FEEDER} string, {C.FEEDER_ID} string, "
        f"{C.TITLE} string, {C.VIDEO_ID} string, {C.SECONDS} bigint, {C.WATCH_TIME} bigint")
    r = autoplay_share(attributed, ["dest"]).first()
    assert (r.Total_Watch_Time, r.New_Watch_Times, r.Prc_of_Total) == (0.0, 0.0, None)


def test_tiebreak_orders_lags_but_not_runs(spark):
    t = T(2024, 1, 5, 10, 0)
    rows = [
        row(t, "Vdo_End", "A", "B", 40),
        row(t, "Auto-Play", "A", "A", None),
    ]
    df = spark.createDataFrame(rows, TL_SCHEMA)
    s = sessionize(df, tiebreak=[C.START_TYPE]).orderBy(C.START_TYPE).collect()
    # with the tie broken by start type, the Vdo_End row follows the Auto-Play row
    assert [(r[C.START_TYPE], r[C.LAST_ACTION]) for r in s] == [("Auto-Play", None), ("Vdo_End", "Auto-Play")]
    assert {r[C.RUN] for r in s} == {1}          # both rows: run ids still share the tie
