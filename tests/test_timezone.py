"""Results do not depend on the session time zone."""

from conftest import SF_SMALL
from watchpath.plans.registry import queries


def test_session_zone_does_not_move_results(spark):
    names = ["attributed_timeline_display", "top_feeders_daily", "promo_reach_hours"]
    before = {n: sorted(tuple(r) for r in queries()[n](spark, SF_SMALL).collect()) for n in names}
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        after = {n: sorted(tuple(r) for r in queries()[n](spark, SF_SMALL).collect()) for n in names}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert before == after
