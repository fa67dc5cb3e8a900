"""Rule tables on literal rows: each CASE branch of the Column expressions."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from watchpath import columns as C
from watchpath.functions import (
    DateScope,
    attributed_start_type,
    clean_title,
    clean_title_promo,
    clicked_title,
    device_family,
    new_watch_time,
    round_hours,
    series_or_null,
    start_type,
)

BRAND = "player"


def test_device_family(spark):
    rows = [
        ("Xfinity", "x:1001", None, "Xfinity Flex"),
        ("xfinity", "x:2002", None, "xfinity X1"),
        ("xfinity", None, None, "xfinity X1"),
        ("Android TV", None, "Chromecast", "Google TV"),
        ("Chromecast Receiver App", None, "chromecast", "Chromecast Receiver App"),
        ("Xbox One", None, None, "xbox"),
        ("PS4", None, None, "playstation"),
        ("Roku", None, "chromecast", "Roku"),
        (None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "p string, c string, k string, want string")
    got = df.select(device_family("p", "c", "k").alias("got"), "want").collect()
    assert [r.got for r in got] == [r.want for r in got]


START_CASES = [
    # details, player event, start type, title
    ("series:cue-up||Show A|auto-play", "player:home", "Auto-Play", "Show A"),
    ("series:cue-up||Show A|click", "player:home", "Clicked-Up-Next", "Show A"),
    ("series:cue-up||Show A|dismiss", "player:home", "Dismiss", None),
    ("browse", "player:details:Show B", "Manual-Selection", "Show B"),
    ("deeplink|Show C", "player:home", "Manual-Selection", None),
    ("rail|Show D|click", "player:home", "Manual-Selection", "Show D"),
    ("browse", "player:home", None, None),
    # details are tested first for the type, the player event first for the title
    ("series:cue-up||Show A|auto-play", "player:details:episodes:Show E", "Auto-Play", "Show E"),
    ("rail|x|click", "player:details:upsell:Show F", "Manual-Selection", "Show F"),
    ("rail|x|click", "player:details:more-like-this:Show G", "Manual-Selection", "Show G"),
    ("rail|x|click", "player:details:extras:Show H", "Manual-Selection", "Show H"),
    # greedy: from the first '||' to the last '|'
    ("a||b|c||d|auto-play", "player:home", "Auto-Play", "b|c||d"),
    # apostrophes are outside the rail title class -> NULL, never ''
    ("rail|it's|click", "player:home", "Manual-Selection", None),
    # auto-play detail without '||' -> NULL title, not ''
    ("x|auto-play", "player:home", "Auto-Play", None),
    # prefix removal is unanchored and global
    ("browse", "x player:details:episodes:A player:details:episodes:", "Manual-Selection", "x A "),
    (None, "player:details:Show", None, None),
]


@pytest.mark.parametrize("details,pe,kind,title", START_CASES)
def test_start_type_and_title(spark, details, pe, kind, title):
    df = spark.createDataFrame([(details, pe)], "d string, pe string")
    r = df.select(start_type("d", "pe").alias("k"), clicked_title("d", "pe", BRAND).alias("t")).first()
    assert (r.k, r.t) == (kind, title)


RULE_CASES = [
    # feeder, title, secs, episode_time, last action, raw type -> expected (rule)
    (None, "A", 100, 0, None, "Vdo_End", "Manual-Selection"),                 # R1
    ("Some Trailer", "A", 100, 0, None, "Vdo_End", "Manual-Selection"),        # R2
    ("B", "A", 100, 0, "Manual-Selection", "Vdo_End", "Manual-Selection"),     # R3
    ("B", "A", 100, 5, "Auto-Play", "Vdo_End", "Auto-Play"),                   # R4
    ("B", "A", 100, 5, "Clicked-Up-Next", "Vdo_End", "Clicked-Up-Next"),       # R5
    ("B", "A", 100, 5, "Dismiss", "Vdo_End", "Auto-Play"),                     # R6
    ("B", "A", 30, 0, "Dismiss", "Vdo_End", "Auto-Play"),                      # R7
    ("B", "A", 31, 0, "Dismiss", "Vdo_End", "Unattributed"),                   # R8
    ("", "A", None, None, None, "Auto-Play", "Manual-Selection"),              # R9 blank
    (None, "A", None, None, None, "Auto-Play", "Manual-Selection"),            # R9 null
    ("A", "A", 100, 0, "Dismiss", "Vdo_End", "Vdo_End"),                       # R10
    ("", "A", 29, 0, "Dismiss", "Vdo_End", "Vdo_End"),                         # '' fails R7
    ("B", "A", None, 0, "Dismiss", "Dismiss", "Dismiss"),                      # NULL secs
]


@pytest.mark.parametrize("feeder,title,secs,ep,prev,kind,want", RULE_CASES)
def test_attributed_start_type(spark, feeder, title, secs, ep, prev, kind, want):
    schema = (f"{C.FEEDER} string, {C.TITLE} string, {C.SECONDS} bigint, {C.EPISODE_TIME} bigint, "
              f"{C.LAST_ACTION} string, {C.START_TYPE} string")
    df = spark.createDataFrame([(feeder, title, secs, ep, prev, kind)], schema)
    assert df.select(attributed_start_type().alias("r")).first().r == want


@pytest.mark.parametrize("feeder,title,secs,ep,want", [
    (None, "A", 10, 5, 15),          # NULL feeder is a head
    ("B", "A", 10, 5, 15),           # moved on: head
    ("A", "A", 10, 5, 0),            # continuation
    ("", "A", None, 7, 7),           # blank feeder click is a head, NULL secs -> 0
    ("B", "A", 10, None, None),      # orphaned run: NULL episode time
    ("B", None, 10, 5, 0),           # unknown comparison -> not a head
])
def test_new_watch_time(spark, feeder, title, secs, ep, want):
    schema = f"{C.FEEDER} string, {C.TITLE} string, {C.SECONDS} bigint, {C.EPISODE_TIME} bigint"
    df = spark.createDataFrame([(feeder, title, secs, ep)], schema)
    assert df.select(new_watch_time().alias("w")).first().w == want


@pytest.mark.parametrize("name,want", [
    ("ABC", None), ("abcd", None), ("abcde", "abcde"), ("Local TV", None), ("Foo (East)", None),
    ("WABC-DT", None), ("Foo Premium", None), ("ktvh-dt", None), ("KABC-X", None),
    ("WXYZ-1", None), ("Kgwn.2", "kgwn2"), ("Law & Order: SVU", "law  order svu"), (None, None),
])
def test_series_or_null(spark, name, want):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(series_or_null("n").alias("s")).first().s == want


def test_clean_titles(spark):
    df = spark.createDataFrame([("It's: A.B, & C!_x",)], "t string")
    r = df.select(clean_title("t").alias("a"), clean_title_promo("t").alias("b")).first()
    assert r.a == "its ab  c_x"
    assert r.b == "its ab,  c!x"


def test_round_hours_matches_exact_decimal(spark):
    secs = list(range(0, 20000, 7)) + [522, 1026, 2034, 1800, 5400, 1799]
    df = spark.createDataFrame([(s,) for s in secs], "s bigint")
    got = df.select("s", round_hours("s", 2).alias("h2"), round_hours("s", 0).alias("h0")).collect()
    for r in got:
        exact = Decimal(r.s) / Decimal(3600)
        assert r.h2 == float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP)), r.s
        assert r.h0 == float(exact.quantize(Decimal("1"), ROUND_HALF_UP)), r.s


def test_split_fifth_field(spark):
    df = spark.createDataFrame([("s|a|b|c|v1",), ("s|a",), ("",), (None,)], "c string")
    got = [r.v for r in df.select(F.get(F.split("c", "[|]"), 4).alias("v")).collect()]
    assert got == ["v1", None, None, None]


def test_date_scope():
    assert DateScope.between("2024-01-01", "2024-01-03").days() == 3
    now = dt.datetime(2024, 3, 10, 3, 0, tzinfo=dt.timezone.utc)   # 2024-03-09 22:00 Eastern
    assert DateScope.yesterday(now=now).start == dt.date(2024, 3, 8)
    t = DateScope.trailing(21, 3, today=dt.date(2024, 1, 31))
    assert (t.start, t.end) == (dt.date(2024, 1, 10), dt.date(2024, 1, 28))
    with pytest.raises(ValueError):
        DateScope.between("2024-01-02", "2024-01-01")
