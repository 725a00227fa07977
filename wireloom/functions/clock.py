"""Times of the log: written in GMT+8, handled as instants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Offset of the log clock, and the layout of a log time.
LOG_ZONE_MS = 8 * 3600 * 1000
DAY_MS = 24 * 3600 * 1000
LOG_TIME_LAYOUT = "^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2},[0-9]{3}$"


def parse_log_time(day: Column, time: Column) -> Column:
    """Instant of a log line, null unless day and time have the exact layout.

    The day is a date and the time is counted from its parts, so the session time zone has no influence, and no zone
    is looked up for each line.
    """

    def part(start: int, length: int) -> Column:
        return F.substring(time, start, length).try_cast("int")

    hour, minute, second, milli = part(1, 2), part(4, 2), part(7, 2), part(10, 3)
    days = F.unix_date(day.try_cast("date")).cast("long")
    ms = days * DAY_MS + ((hour * 60 + minute) * 60 + second) * 1000 + milli - LOG_ZONE_MS
    there = F.concat_ws(" ", day, time).rlike(LOG_TIME_LAYOUT) & (hour < 24) & (minute < 60) & (second < 60)
    return F.when(there, F.timestamp_millis(ms))


def millis(ts: Column) -> Column:
    return F.unix_millis(ts)


def log_day(ts: Column) -> Column:
    """Calendar day of an instant on the log clock, whatever the session time zone."""
    days = F.floor((millis(ts) + LOG_ZONE_MS) / DAY_MS).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days)


def whole_minutes(later: Column, earlier: Column) -> Column:
    """Whole minutes from ``earlier`` to ``later``."""
    return F.floor((millis(later) - millis(earlier)) / 60000)
