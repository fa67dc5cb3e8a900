"""Seconds -> hours with exact decimal rounding (half away from zero).

Rounding ``seconds / 3600`` as a float depends on how an engine rounds the
binary value (0.145 is stored as 0.14499...). The hours here are rounded
from the integer seconds instead, so every engine agrees and sums of
rounded values are exact.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _scaled(seconds: Column, digits: int) -> Column:
    unit = 3600 // (10 ** digits)          # seconds per 10^-digits hour
    half = unit // 2
    return F.signum(seconds) * F.floor((F.abs(seconds) + half) / unit)


def hour_hundredths(seconds: str | Column) -> Column:
    """Hours rounded to 2 decimals, as an integer count of hundredths."""
    s = F.col(seconds) if isinstance(seconds, str) else seconds
    return _scaled(s, 2).cast("bigint")


def round_hours(seconds: str | Column, digits: int = 2) -> Column:
    """``round(seconds / 3600, digits)`` as a double, for digits 0, 1 or 2."""
    if digits not in (0, 1, 2):
        raise ValueError("digits must be 0, 1 or 2")
    s = F.col(seconds) if isinstance(seconds, str) else seconds
    return (_scaled(s, digits).cast("bigint") / F.lit(10 ** digits)).cast("double")
