"""Windows over range partitions give the plain windows' results, with the hot key spread."""

import contextlib
import datetime as dt
import io
import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from watchpath import columns as C
from watchpath.operators import carry
from watchpath.operators.timeline import IS_PLAY, KEYS, attribute, dealt_timeline, with_feeders
from watchpath.operators.clicks import classify_clicks, normalize_clicks
from watchpath.operators.plays import play_rows
from watchpath.plans import params as P
from watchpath.plans.attribution import attributed_timeline
from watchpath.plans.promo import promo_reach, promo_reach_hourly
from watchpath.plans.registry import queries, tables
from watchpath.sources.standin import PLAYER_EVENT_BRAND as BRAND


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def burst(spark, seed):
    """A bot with most rows, most of them at one instant; ordinary, NULL and tied keys beside it."""
    rng, data = random.Random(seed), []
    for i in range(400):
        k = rng.choice(["bot"] * 4 + ["a", "b", "c", None])
        t = rng.choice([5, 5, 5, rng.randint(0, 30)]) if k == "bot" else rng.randint(0, 20)
        data.append((k, 1, t, rng.choice("xy"), rng.choice([0, 0, 0, 1]), rng.choice([None, 1, 2, 3]), i))
    return spark.createDataFrame(data, "k string, d int, t int, kind string, h int, amount int, i int")


@pytest.mark.parametrize(("seed", "parts"), [(0, 3), (1, 9), (2, 40)])
def test_carried_windows_equal_plain_windows(spark, seed, parts):
    keys, order = ["k", "d"], ["t"]
    dealt = carry.deal(burst(spark, seed), keys, order, parts=parts)
    plain = Window.partitionBy(*keys).orderBy(*order)
    lag = F.lag("i").over(Window.partitionBy(*keys, "kind").orderBy("t", carry.TIE))
    assert rows(carry.carried_lags(dealt, keys, order, [("p", "i")], by=["kind"]).select("i", "p")) == rows(dealt.select("i", lag))
    for some, whole in ((dealt, None), (dealt.where("i % 5 < 3"), dealt)):
        total = F.sum("i").over(Window.partitionBy(*keys))
        got = carry.carried_sums(some, keys, order, [("r", F.col("h")), ("x", F.col("i") * 0.5)],
                                 [("s", F.col("i")), ("y", F.col("h") * 2.0)], dealt=whole)
        y = F.sum(F.col("h") * 2.0).over(Window.partitionBy(*keys))
        assert rows(got.select("i", "r", "x", "s", "y")) == rows(some.select(
            "i", F.sum("h").over(plain), F.sum(F.col("i") * 0.5).over(plain), total, y))
        got = carry.carried_runs(some, keys, order, F.col("h"), F.col("amount"), "r", "s", dealt=whole,
                                 lags=[("p", "i")]).select("i", "p", "r", "s")
        want = some.withColumn("r", F.sum("h").over(plain)).select(
            "i", F.lag("i").over(Window.partitionBy(*keys).orderBy("t", carry.TIE)), "r",
            F.sum("amount").over(Window.partitionBy(*keys, "r")))
        assert rows(got) == rows(want)


def test_a_burst_in_one_second_is_spread(spark):
    second = dt.datetime(2024, 1, 5, 12)
    data = [("bot", second + dt.timedelta(microseconds=100 * i), i) for i in range(3000)] + [(f"u{i}", second, i) for i in range(200)]
    dealt = carry.deal(spark.createDataFrame(data, "k string, t timestamp_ntz, i int"), ["k"], ["t"], parts=16)
    sizes = [r["count"] for r in dealt.groupBy(carry.PART).count().collect()]
    assert len(sizes) >= 12 and max(sizes) < 3 * 3200 / 16


def test_empty_and_single_rows(spark):
    one = spark.createDataFrame([("a", 1, 2)], "k string, t int, h int")
    for df, n in ((one.limit(0), 0), (one, 1)):
        dealt = carry.deal(df, ["k"], ["t"])
        assert carry.carried_lags(dealt, ["k"], ["t"], [("p", "h")]).count() == n
        assert carry.carried_sums(dealt, ["k"], ["t"], [("r", F.col("h"))], [("s", F.col("h"))]).count() == n
        assert carry.carried_runs(dealt, ["k"], ["t"], F.col("h"), F.col("h"), "r", "s").count() == n


def plain_timeline(t, scope, feeder):
    """The attributed timeline with ordinary windows over (account, day)."""
    start, end = t.scope()
    clicks = classify_clicks(normalize_clicks(t.clickstream(start, end), start, end), BRAND,
                             title=P.TARGET if scope == "display" else None)
    both = dealt_timeline(clicks, play_rows(t.video(start, end), start, end))
    w = Window.partitionBy(*KEYS, IS_PLAY).orderBy(C.TIME)
    play = F.col(IS_PLAY)
    lag = F.lag(C.TITLE).over(w) if feeder == "lag" else F.when(play, F.lag(C.TITLE).over(w)).otherwise("")
    x = both.withColumn(C.FEEDER, lag).withColumn(C.FEEDER_ID, F.when(play, F.lag(C.VIDEO_ID).over(w)).otherwise(""))
    x = x.where(F.lower(C.TITLE if scope == "display" else C.FEEDER) == P.TARGET)
    w, cont = Window.partitionBy(*KEYS).orderBy(C.TIME), F.col(C.FEEDER) == F.col(C.TITLE)
    x = x.withColumn(C.LAST_ACTION, F.lag(C.START_TYPE).over(w)).withColumn(C.RUN, F.sum(F.when(cont, 0).otherwise(1)).over(w))
    total = F.sum(F.when(cont, F.col(C.SECONDS)).otherwise(0)).over(Window.partitionBy(*KEYS, C.RUN))
    return attribute(x.withColumn(C.EPISODE_TIME, total))


@pytest.mark.parametrize("scope,feeder", [("display", "lag"), ("display", "blank"), ("feeder", "lag")])
def test_timeline_equals_plain_windows(spark, scope, feeder):
    t = tables(spark, SF_MID)
    got = attributed_timeline(t, *t.scope(), P.TARGET, BRAND, scope, feeder, parts=50)
    assert rows(got) == rows(plain_timeline(t, scope, feeder))


def test_promo_does_not_depend_on_parts(spark):
    t = tables(spark, SF_SMALL)
    args = (t, *t.scope(), t.scope().start, P.PROMO_ORIGINS, P.TARGET, P.PROMO_VIEW_TITLES)
    for plan in (promo_reach, promo_reach_hourly):
        assert rows(plan(*args, parts=1)) == rows(plan(*args, parts=30))


@pytest.mark.parametrize(("name", "most"), [("attributed_timeline_display", 4), ("attributed_timeline_feeder", 4),
                                            ("promo_reach_hours", 8), ("promo_hourly_from", 8)])
def test_scans_stay_few(spark, name, most):
    told = io.StringIO()
    with contextlib.redirect_stdout(told):
        queries()[name](spark, SF_SMALL).explain()
    assert len(re.findall(r"FileScan", told.getvalue())) <= most, told.getvalue()


def test_feeders_of_an_unknown_mode(spark):
    with pytest.raises(ValueError):
        with_feeders(spark.range(0), "last")
