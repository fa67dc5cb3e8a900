"""End-to-end compositions of the operators (the reports)."""

from watchpath.plans.attribution import attributed_timeline
from watchpath.plans.feeders import (
    device_feed_list,
    device_top_feeders,
    feeder_destination_pairs,
    top_feeders_daily,
)
from watchpath.plans.promo import promo_reach, promo_reach_hourly

__all__ = [
    "attributed_timeline", "device_feed_list", "device_top_feeders", "feeder_destination_pairs",
    "promo_reach", "promo_reach_hourly", "top_feeders_daily",
]
