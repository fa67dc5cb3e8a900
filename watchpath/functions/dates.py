"""Date scopes resolved on the driver and passed to Spark as literals.

Literal bounds let Catalyst prune date partitions at planning time.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from zoneinfo import ZoneInfo

from watchpath.functions.labels import EASTERN


def as_date(d: str | dt.date) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(d)


@dataclass(frozen=True)
class DateScope:
    start: dt.date
    end: dt.date

    @classmethod
    def between(cls, start: str | dt.date, end: str | dt.date) -> "DateScope":
        a, b = as_date(start), as_date(end)
        if b < a:
            raise ValueError(f"empty date scope {a}..{b}")
        return cls(a, b)

    @classmethod
    def day(cls, day: str | dt.date) -> "DateScope":
        return cls.between(day, day)

    @classmethod
    def yesterday(cls, tz: str = EASTERN, now: dt.datetime | None = None) -> "DateScope":
        """The day before today in ``tz`` (the daily reports' scope)."""
        now = now or dt.datetime.now(dt.timezone.utc)
        today = now.astimezone(ZoneInfo(tz)).date()
        return cls.day(today - dt.timedelta(days=1))

    @classmethod
    def trailing(cls, first_back: int, last_back: int,
                 today: dt.date | None = None) -> "DateScope":
        """``today - first_back .. today - last_back`` (UTC calendar by default)."""
        today = today or dt.datetime.now(dt.timezone.utc).date()
        return cls.between(today - dt.timedelta(days=first_back),
                           today - dt.timedelta(days=last_back))

    def __iter__(self):
        """``start, end``: a scope can stand for both in a call (``plan(tables, *scope, ...)``)."""
        return iter((self.start, self.end))

    def days(self) -> int:
        return (self.end - self.start).days + 1
