"""A target title is taken literally and in any case."""

from conftest import SF_SMALL
from pyspark.sql import functions as F

from watchpath.functions.titles import clean_title_promo, clicked_title
from watchpath.plans import params as P
from watchpath.plans.attribution import attributed_timeline
from watchpath.plans.registry import tables
from watchpath.sources.standin import PLAYER_EVENT_BRAND


def test_case_of_the_target_does_not_matter(spark):
    t = tables(spark, SF_SMALL)
    n = [attributed_timeline(t, *t.scope(), name, PLAYER_EVENT_BRAND).count() for name in ("alpha show", "Alpha Show")]
    assert n[0] == n[1] > 0


def test_cleaned_target_and_literal_brand(spark):
    row = spark.range(1).select(
        clean_title_promo(F.lit("Law & Order")).alias("a"),
        clicked_title(F.lit("x"), F.lit("a+b.c:details:Pilot"), "a+b.c").alias("b")).first()
    assert row.a == "law  order" and row.b == "Pilot"
