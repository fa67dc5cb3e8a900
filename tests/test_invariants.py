"""Invariants of the attribution and reach on the stand-in (sf0.01)."""

from pyspark.sql import functions as F

from conftest import SF_MID
from watchpath import columns as C
from watchpath.plans.registry import attributed, queries


def _sums(df):
    r = df.agg(F.sum(C.SECONDS).alias("s"), F.sum(C.WATCH_TIME).alias("w")).first()
    return r.s, r.w


def test_title_scope_conserves_seconds(spark):
    for feeder in ("lag", "blank"):
        s, w = _sums(attributed(spark, SF_MID, "display", feeder))
        assert s == w


def test_feeder_scope_never_credits_more(spark):
    s, w = _sums(attributed(spark, SF_MID, "feeder", "lag"))
    assert w <= s


def test_one_credited_row_per_run(spark):
    sess = queries()["episode_time"](spark, SF_MID)
    heads = (sess.where(F.col(C.FEEDER).isNull() | (F.col(C.FEEDER) != F.col(C.TITLE)))
             .groupBy(C.ACCOUNT, C.DAY, C.RUN).count().where("count > 1"))
    assert heads.count() == 0


def test_reach_bounds(spark):
    r = queries()["conditional_reach"](spark, SF_MID)
    a, n, t = (F.col("Unique_Auto_Binge_Accounts"), F.col("Unique_Click_Next_Accounts"),
               F.col("Total_Unique_Accounts"))
    assert r.where((t < F.greatest(a, n)) | (t > a + n)).count() == 0


def test_daily_rank_is_dense_from_one(spark):
    top = queries()["top_feeders_daily"](spark, SF_MID)
    per_day = top.groupBy(C.DAY).agg(F.min("Daily_Ranks").alias("lo"), F.max("Daily_Ranks").alias("hi"),
                                     F.countDistinct("Daily_Ranks").alias("n")).collect()
    assert per_day
    for r in per_day:
        assert r.lo == 1 and r.hi == r.n
