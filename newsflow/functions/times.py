"""Publication times, look-back frames and month-sharded sitemap URLs."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsflow.functions.tokens import bind

_UNIT_SECONDS = {"h": 3600, "d": 86400, "m": 60}
# Offsets in hours of the zone names that feed dates may use.
_ZONES = {"EST": -5, "EDT": -4, "CST": -6, "CDT": -5, "MST": -7, "MDT": -6, "PST": -8, "PDT": -7}
_ZONE = (
    r"\s*(?:(?:Z|GMT|UTC|UT)?\s*([+-]\d{1,2}(?::?\d{2})?)|Z|GMT|UTC|UT|(" + "|".join(_ZONES) + r"))$"
)
_MONTHS = "Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec"
# Spellings that are brought to `d Mon yyyy`, `yyyy-MM-dd` or `d/M/yyyy` before the time of day.
_SPELLINGS = [
    (rf"\b({_MONTHS})[a-z]*\.?", "$1"),
    (rf"^({_MONTHS}) (\d{{1,2}}),? +(\d{{4}})", "$2 $1 $3"),
    (rf"^(\d{{1,2}})[ -]({_MONTHS})[ -](\d{{4}})", "$1 $2 $3"),
    (rf"^(\d{{1,2}})[ -]({_MONTHS})[ -](\d{{2}})(?!\d)", "$1 $2 20$3"),
    (r"^(\d{4})/(\d{1,2})/(\d{1,2})", "$1-$2-$3"),
    (r"^(\d{1,2})[-.](\d{1,2})[-.](\d{4})", "$1/$2/$3"),
    (r",? +(\d{1,2}:\d{2})(?![:\d])", " $1:00"),
]
_SHAPES = [(rf"^\d{{1,2}} (?:{_MONTHS}) \d{{4}}", "d MMM yyyy"), (r"^\d{1,2}/\d{1,2}/\d{4}", "d/M/yyyy")]


def parse_publish_time(text: Column, tz_mode: str = "utc") -> Column:
    """Timestamp at second precision, null when the text is no known format.

    Accepts ISO, RFC 822, day/month/year and written-out dates, with 24 or 12 hours, each with or
    without an offset or zone name. ``utc`` converts by the offset, ``wallclock`` drops it. A date
    of three numbers that does not begin with the year begins with the day. The session time zone has
    to be UTC.
    """
    if tz_mode not in ("utc", "wallclock"):
        raise ValueError("tz_mode must be 'utc' or 'wallclock'")
    trimmed = F.regexp_replace(F.trim(text), r"^(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)[a-z]*,?\s+", "")
    return bind(trimmed, lambda t: _parse_trimmed(t, tz_mode))


def _parse_trimmed(trimmed: Column, tz_mode: str) -> Column:
    # A date ends in "-dd" as well, so a zone only counts behind a time of day.
    base = F.when(trimmed.contains(":"), F.regexp_replace(trimmed, _ZONE, "")).otherwise(trimmed)
    for pattern, spelled in _SPELLINGS:
        base = F.regexp_replace(base, pattern, spelled)
    wall = bind(base, _wall_clock)
    if tz_mode == "utc":
        behind = rf":.*?{_ZONE}"
        shift = bind(F.regexp_extract(trimmed, behind, 1), _offset_seconds)
        named = F.regexp_extract(trimmed, behind, 2)
        for name, hours in _ZONES.items():
            shift = F.when(named == name, F.lit(hours * 3600)).otherwise(shift)
        wall = F.timestamp_seconds(F.unix_timestamp(wall) - shift)
    return F.date_trunc("second", wall)


def _wall_clock(base: Column) -> Column:
    """The first shape that fits decides the format, so a format is only tried where it fits."""
    parsed = F.when(base.rlike(r"^\d{4}-"), F.try_to_timestamp(base))
    for shape, date in _SHAPES:
        for behind, time in ((r"$", ""), (r".*[AaPp][Mm]$", " h:mm:ss a"), (r" ", " H:mm:ss")):
            text = F.upper(base) if "a" in time and "MMM" not in date else base
            parsed = parsed.when(base.rlike(shape + behind), F.try_to_timestamp(text, F.lit(date + time)))
    return parsed


def _offset_seconds(offset: Column) -> Column:
    digits = F.regexp_replace(offset, "[^0-9]", "")
    brief = F.length(digits) <= 2
    hours = F.when(brief, digits).try_cast("int")
    hours = F.coalesce(hours, digits.substr(F.lit(1), F.length(digits) - 2).try_cast("int"))
    minutes = F.when(brief, F.lit(0)).otherwise(F.right(digits, F.lit(2)).try_cast("int"))
    seconds = F.coalesce(hours * 3600 + minutes * 60, F.lit(0))
    return F.when(offset.startswith("-"), -seconds).otherwise(seconds)


def parse_time_frame(frame: str) -> timedelta:
    """``12h``, ``2d`` or ``30m`` (minutes) as a timedelta; anything else is an error."""
    match = re.fullmatch(r"(\d+)([hdm])", (frame or "").strip().lower())
    if not match or int(match[1]) <= 0:
        raise ValueError(f"time frame must look like 12h, 2d or 30m and be positive: {frame!r}")
    return timedelta(seconds=int(match[1]) * _UNIT_SECONDS[match[2]])


def time_frame_seconds(frame: Column) -> Column:
    """Column form of parse_time_frame: seconds, or null for an invalid frame."""
    text = F.lower(F.trim(frame))
    amount = F.regexp_extract(text, r"^(\d+)[hdm]$", 1).try_cast("bigint")
    unit = F.substring(text, -1, 1)
    factor = F.coalesce(
        *[F.when(unit == name, F.lit(seconds)) for name, seconds in _UNIT_SECONDS.items()]
    )
    return F.when(amount > 0, F.try_multiply(amount, factor))


def month_shard_url(url: Column, as_of: datetime, zero_pad: Column) -> Column:
    """Put the month of as_of into a month-sharded sitemap URL; other URLs stay as they are."""
    padded = F.regexp_replace(url, r"-\d{4}-\d{1,2}\.xml", f"-{as_of:%Y-%m}.xml")
    plain = F.regexp_replace(url, r"-\d{4}-\d{1,2}\.xml", f"-{as_of.year}-{as_of.month}.xml")
    sharded = url.rlike(r"sitemaps-\d{4}-\d{2}\.xml") | url.rlike(r"news-\d{4}-\d{1,2}\.xml")
    return F.when(sharded & zero_pad, padded).when(sharded, plain).otherwise(url)
