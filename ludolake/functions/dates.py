"""Unix epoch seconds to dates and text, independent of the session time zone."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day range date_from_unix_date can turn into years 0001-9999.
_FIRST_DAY, _LAST_DAY = -719162, 2932896


def _days(seconds: Column) -> Column:
    days = F.floor(seconds / F.lit(86400))
    return F.when(days.between(_FIRST_DAY, _LAST_DAY), days.cast("int"))


def epoch_date(seconds: Column) -> Column:
    """UTC calendar date of an epoch; NULL when it is outside years 1-9999."""
    return F.date_from_unix_date(_days(seconds))


def epoch_day_text(seconds: Column) -> Column:
    """``yyyy-MM-dd`` in UTC."""
    return F.date_format(epoch_date(seconds), "yyyy-MM-dd")


def epoch_minute_text(seconds: Column) -> Column:
    """``yyyy-MM-dd HH:mm`` in UTC."""
    minute = F.pmod(F.floor(seconds / F.lit(60)), F.lit(1440))
    clock = F.format_string("%02d:%02d", F.floor(minute / F.lit(60)), F.pmod(minute, F.lit(60)))
    # concat, not concat_ws: no day, no text.
    return F.concat(epoch_day_text(seconds), F.lit(" "), clock)


def iso_timestamp(text: Column) -> Column:
    """Instant of an ISO-8601 date or time; one without an offset counts as UTC, and junk is NULL."""
    clock = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}.*"
    offset = F.regexp_extract(text, clock + r"?([+-]\d{2}(:?\d{2})?)$", 1)
    # Offsets in the one form that the parser takes everywhere: +hh:mm.
    hours, minutes = F.substring(offset, 1, 3), F.regexp_extract(offset, r"^.\d{2}:?(\d{2})$", 1)
    minutes = F.when(minutes == "", "00").otherwise(minutes)
    bare = F.substring(text, F.lit(1), F.length(text) - F.length(offset))
    full = F.when(offset != "", F.concat(bare, hours, F.lit(":"), minutes)).when(text.endswith("Z"), text)
    known = text.rlike(clock + "$") | text.rlike(r"^\d{4}-\d{2}-\d{2}$")
    return F.try_to_timestamp(F.when(known, F.coalesce(full, F.concat(text, F.when(text.contains(":"), "Z").otherwise("T00:00:00Z")))))


def epoch_of(moment: datetime) -> int:
    """Whole epoch seconds of a Python datetime; a naive one counts as UTC."""
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return int(moment.timestamp() // 1)


def run_date(moment: datetime | None = None) -> str:
    """Partition date of a run, in UTC."""
    moment = moment or datetime.now(timezone.utc)
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc)
    return moment.strftime("%Y-%m-%d")
