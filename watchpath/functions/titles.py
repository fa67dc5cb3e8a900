"""Start type, clicked title and title cleaning (Column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from watchpath.functions.labels import (
    AUTO_PLAY,
    CUE_TITLE_PATTERN,
    DETAIL_AREAS,
    DISMISS,
    MANUAL,
    PROMO_STRIP_CHARS,
    RAIL_TITLE_PATTERN,
    STATION_CALL_SIGNS,
    STATION_MAX_LENGTH,
    STATION_NAMES,
    STATION_SUFFIXES,
    TITLE_STRIP_CHARS,
    UP_NEXT,
)
from watchpath.functions.memo import memo_column


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _extract_or_null(c: Column, pattern: str) -> Column:
    """First capture group, NULL when the pattern does not match.

    ``regexp_extract`` alone yields '' on no match; an empty title would be
    taken for a real feeder by the next row, so the match is tested first.
    """
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, 1))


@memo_column
def start_type(details: str | Column = "Binge_Details",
               player_event: str | Column = "Player_Event") -> Column:
    """How a click started a viewing; NULL when it is not a start signal.

    The detail string is tested before the player event, so an auto-play hit
    on a details page is Auto-Play.
    """
    d, pe = _col(details), _col(player_event)
    return (
        F.when(d.like("%auto-play"), AUTO_PLAY)
        .when(d.like("%cue%up%click"), UP_NEXT)
        .when(d.like("%dismiss"), DISMISS)
        .when(pe.like("%details:%") & d.isNotNull(), MANUAL)
        .when(d.like("%deeplink%"), MANUAL)
        .when(d.like("rail%click"), MANUAL)
    )


@memo_column
def clicked_title(details: str | Column = "Binge_Details",
                  player_event: str | Column = "Player_Event",
                  brand: str = "") -> Column:
    """Title a click refers to.

    The player event is tested first (``<brand>:details:<area>:<title>``,
    prefix removed wherever it occurs), then the detail string (auto-play
    and up-next: text between the first ``||`` and the last ``|``; rail
    clicks: a plain title between pipes). NULL otherwise.
    """
    d, pe = _col(details), _col(player_event)
    on_page = d.isNotNull()
    title = None
    for area in DETAIL_AREAS:
        cond = pe.like(f"%:{area}:%") & on_page
        value = F.replace(pe, F.lit(f"{brand}:details:{area}:"), F.lit(""))
        title = F.when(cond, value) if title is None else title.when(cond, value)
    cue = _extract_or_null(d, CUE_TITLE_PATTERN)
    return (
        title.when(pe.like("%:details:%") & on_page, F.replace(pe, F.lit(f"{brand}:details:"), F.lit("")))
        .when(d.like("%auto-play"), cue)
        .when(d.like("%cue%up%click"), cue)
        .when(d.like("rail%click"), _extract_or_null(d, RAIL_TITLE_PATTERN))
    )


@memo_column
def clean_title(c: str | Column, chars: str = TITLE_STRIP_CHARS) -> Column:
    """Lower-case and drop punctuation, the join key of feeders and series."""
    return F.translate(F.lower(_col(c)), chars, "")


@memo_column
def clean_title_promo(c: str | Column) -> Column:
    """Cleaning used by the promo report: drop ``. & _ ' :`` then lower-case."""
    return clean_title(c, PROMO_STRIP_CHARS)


@memo_column
def series_or_null(display_name: str | Column = "display_name") -> Column:
    """Cleaned series name, NULL when the name is a station or platform."""
    dn = _col(display_name)
    low = F.lower(dn)
    station = F.length(dn) <= STATION_MAX_LENGTH
    for suffix in STATION_SUFFIXES:
        station = station | low.like(suffix)
    station = station | low.isin(*STATION_NAMES)
    for pattern in STATION_CALL_SIGNS:
        station = station | dn.rlike(pattern)
    return F.when(station, F.lit(None).cast("string")).otherwise(clean_title(dn))
