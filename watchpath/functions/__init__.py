"""Column expressions. Each returns a ``pyspark.sql.Column`` built from
built-in functions only, so it stays inside whole-stage codegen."""

from watchpath.functions.dates import DateScope
from watchpath.functions.devices import device_family
from watchpath.functions.hours import hour_hundredths, round_hours
from watchpath.functions.rules import attributed_start_type, new_watch_time
from watchpath.functions.titles import (
    clean_title,
    clean_title_promo,
    clicked_title,
    series_or_null,
    start_type,
)

__all__ = [
    "DateScope", "attributed_start_type", "clean_title", "clean_title_promo",
    "clicked_title", "device_family", "hour_hundredths", "new_watch_time",
    "round_hours", "series_or_null", "start_type",
]
